"""Hard negatives by angular triangle filtering.

Each row's angles to a few reference directions are stored with it. For an
anchor and a block of rows, the triangle inequality on the sphere turns stored
angles into an interval of cosines, and the norms turn that into bounds of the
score, widened for rounding. Only blocks whose bounds overlap a window that the
anchor still needs get exact integer scores.

The anchors are a stated query set. Rows and anchors are dealt to groups of
bounded size; a task keeps one group of anchors and streams rows past them, in
an order that gives neighbouring rows similar angles. A label that a third of
all rows have is spread over all groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Reference directions, and the bounded sample (rows, components) that they are chosen from. Results do not depend on either.
DIRECTIONS, SAMPLE, COMPONENTS = 16, 1024, 1024
#: Anchors of a group, rows of a group, rows of a block, anchors that are scored at once.
ANCHORS, ROWS, BLOCK, AT_ONCE = 200_000, 2_000_000, 512, 2048
#: Radians that a stored angle may be off; scores that bounds may be off.
ANGLE_SLACK, SCORE_SLACK = 1e-5, 1.0


@dataclass
class Vectors:
    """Rows as arrays: ids, labels, integer components as floats, norms, angles to the directions."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    def __getitem__(self, at) -> Vectors:
        return Vectors(self.ids[at], self.labels[at], self.q[at], self.norms[at], self.angles[at])


def _matrix(lists: pa.Array) -> np.ndarray:
    """The lists as rows of one matrix; shorter ones end in zeros, null components are NaN."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), dtype=flat.dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def directions(rows: DataFrame) -> np.ndarray:
    """Unit vectors far from each other, out of a sample of rows by the hash of their ids."""
    sample = rows.where("embedding is not null").select(F.slice("embedding", 1, COMPONENTS).alias("e"), F.xxhash64("vec_id").alias("h")).orderBy("h").limit(SAMPLE)
    vectors = [[x if x is not None and math.isfinite(x) else 0.0 for x in r["e"]] for r in sample.collect()]
    width = max(map(len, vectors), default=0) or 1
    x = np.array([v + [0.0] * (width - len(v)) for v in vectors]).reshape(-1, width)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=1e-300, keepdims=True))[1])  # no square overflows
    norms = np.linalg.norm(x, axis=1)
    x = x[norms > 0] / norms[norms > 0, None]
    if not len(x):
        return np.eye(1, width)
    chosen = [int(np.argmax(x @ x.mean(0)))]
    nearest = x @ x[chosen[0]]
    while len(chosen) < min(DIRECTIONS, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def index(rows: DataFrame, refs: np.ndarray, scale: float = 256.0) -> DataFrame:
    """(row, vec_id, label, q, w, norm, angles, cell, near) of the rows that take part.

    ``rows(vec_id, label, embedding)``. A component x becomes floor(scale * x).
    Rows with a null vec_id, label or vector, with a null component or with one whose
    scaled value is not finite take no part. Components are in ``q``, in ``w`` where they do not fit 16
    bits. ``cell`` is the nearest direction and ``near`` the angle to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2)).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(scale * x)
            keep = np.isfinite(q).all(1)
            q = q[keep]
            size = np.exp2(np.floor(np.log2(np.maximum(np.abs(q).max(1, initial=1), 1))))[:, None]  # no square overflows
            norms = np.linalg.norm(q / size, axis=1) * size[:, 0]
            width = max(q.shape[1], refs.shape[1])
            dots = _widened(q, width) @ _widened(refs, width).T
            cosines = np.divide(dots, norms[:, None], out=np.zeros_like(dots), where=norms[:, None] > 0)
            angles = np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)
            cells = angles.argmin(1)
            small = (np.abs(q) < 2**15).all(1)
            lengths = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)[keep]
            ids, labels = (batch.column(i).filter(pa.array(keep)) for i in (0, 1))
            yield pa.record_batch(
                [
                    ids, labels,
                    pa.array([v[:n].astype(np.int16) if s else None for v, n, s in zip(q, lengths, small, strict=True)], pa.list_(pa.int16())),
                    pa.array([None if s else v[:n] for v, n, s in zip(q, lengths, small, strict=True)], pa.list_(pa.float64())),
                    pa.array(norms), pa.array(list(angles), pa.list_(pa.float32())),
                    pa.array(cells, pa.int32()), pa.array(angles[np.arange(len(cells)), cells], pa.float32()),
                ],
                ["vec_id", "label", "q", "w", "norm", "angles", "cell", "near"],
            )

    whole = rows.where("vec_id is not null and label is not null and embedding is not null")
    whole = whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    schema = "vec_id long, label long, q array<short>, w array<double>, norm double, angles array<float>, cell int, near float"
    return whole.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


class Search:
    """The best rows of each window of each anchor, among the blocks of rows met so far.

    ``low`` and ``high`` are the windows (anchors x windows), inclusive. ``same``
    looks among rows of the anchor's label, else among the others; rows with the
    anchor's own id never count. Ties go to smaller ids.
    """

    def __init__(self, anchors: Vectors, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.anchors, self.low, self.high, self.same, self.k = anchors, low, high, same, k
        self.windows = low.shape[1]
        self.scores = np.full((low.size, k), -np.inf)
        self.ids = np.full((low.size, k), np.iinfo(np.int64).max)
        self.by_id = np.argsort(anchors.ids)
        self.scored = 0

    def least(self, at: np.ndarray) -> np.ndarray:
        """What a score must reach for each window of the anchors ``at``."""
        return np.maximum(self.low[at], self.scores.reshape(-1, self.windows, self.k)[at, :, -1])

    def meet(self, block: Vectors) -> None:
        labels = self.anchors.labels
        if self.same:
            at = np.flatnonzero((labels >= block.labels.min()) & (labels <= block.labels.max()))
        else:
            one = (block.labels == block.labels[0]).all()
            at = np.flatnonzero(labels != block.labels[0]) if one else np.arange(len(labels))
        for i in range(0, len(at), AT_ONCE):
            overlapping = self.overlapping(at[i : i + AT_ONCE], block)
            if len(overlapping):
                self.score(overlapping, block)

    def overlapping(self, at: np.ndarray, block: Vectors) -> np.ndarray:
        """Anchors of ``at`` for which the block's score bounds overlap a window."""
        low, high = score_bounds(self.anchors.angles[at], self.anchors.norms[at], block)
        need = (high[:, None] >= self.least(at)) & (low[:, None] <= self.high[at])
        return at[need.any(1)]

    def score(self, at: np.ndarray, block: Vectors) -> None:
        largest = float(self.anchors.norms[at].max()) * float(block.norms.max()) * (1 + 1e-9)
        # all partial sums are integers below the product of the norms: exact in a float of enough bits
        kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.longdouble
        if kind is np.longdouble and self.scores.dtype != kind:
            self.scores = self.scores.astype(kind)
        width = max(self.anchors.q.shape[1], block.q.shape[1])
        s = _widened(self.anchors.q[at], width).astype(kind) @ _widened(block.q, width).astype(kind).T
        self.scored += s.size
        least, high = self.least(at).astype(kind), self.high[at].astype(kind)
        fits = (s >= least.min(1)[:, None]) & (s <= high.max(1)[:, None])
        self.exclude(fits, at, block)
        crowded = np.flatnonzero(np.count_nonzero(fits, axis=1) > 8 * self.k)
        if len(crowded):
            for w in range(self.windows):
                inside = fits[crowded] & (s[crowded] >= least[crowded, w, None]) & (s[crowded] <= high[crowded, w, None])
                kth = np.partition(np.where(inside, s[crowded], -np.inf), -self.k, axis=1)[:, -self.k]
                least[crowded, w] = np.maximum(least[crowded, w], kth)
            fits[crowded] &= s[crowded] >= least[crowded].min(1)[:, None]
        a, x = np.nonzero(fits)
        s = s[a, x]
        for w in range(self.windows):
            inside = (s >= least[a, w]) & (s <= high[a, w])
            self.merge(at[a[inside]] * self.windows + w, s[inside], block.ids[x[inside]])

    def exclude(self, fits: np.ndarray, at: np.ndarray, block: Vectors) -> None:
        labels = self.anchors.labels[at]
        if labels.min() != labels.max() or (block.labels != labels[0]).any():
            same = labels[:, None] == block.labels[None, :]
            fits &= same if self.same else ~same
        elif not self.same:
            fits[:] = False
        ids = self.anchors.ids
        place = self.by_id[np.minimum(np.searchsorted(ids, block.ids, sorter=self.by_id), len(ids) - 1)]
        own = np.flatnonzero(ids[place] == block.ids)
        local = np.minimum(np.searchsorted(at, place[own]), len(at) - 1)
        here = at[local] == place[own]
        fits[local[here], own[here]] = False

    def merge(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        touched = np.unique(lists)
        keys = np.concatenate([lists, np.repeat(touched, self.k)])
        scores = np.concatenate([scores.astype(self.scores.dtype), self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -scores, keys))
        keys = keys[order]
        rank = np.arange(len(keys)) - np.searchsorted(keys, keys)
        keep = rank < self.k
        self.scores[keys[keep], rank[keep]] = scores[order][keep]
        self.ids[keys[keep], rank[keep]] = ids[order][keep]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, id, score) of all lists."""
        lists, places = np.nonzero(self.scores > -np.inf)
        scores = np.clip(self.scores[lists, places].astype(np.longdouble), np.iinfo(np.int64).min, np.iinfo(np.int64).max)
        return lists // self.windows, lists % self.windows, self.ids[lists, places], scores.astype(np.int64)


def score_bounds(angles: np.ndarray, norms: np.ndarray, block: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of anchors (angles, norms) with all rows of a block.

    The angle between two vectors is at least the difference of their angles to
    any direction, and at most their sum and what the sum lacks to a full turn.
    """
    least, most = block.angles.min(0).astype(np.float64), block.angles.max(0).astype(np.float64)
    angles = angles.astype(np.float64)
    apart = np.maximum(least - angles, angles - most).max(1)
    together = np.minimum(angles + most, 2 * np.pi - (angles + least)).min(1)
    top = np.cos(np.clip(apart - ANGLE_SLACK, 0, np.pi))
    bottom = np.cos(np.clip(together + ANGLE_SLACK, 0, np.pi))
    small, large = block.norms.min(), block.norms.max()
    with np.errstate(over="ignore", invalid="ignore"):
        slack = SCORE_SLACK + 1e-9 * norms * large
        high = norms * np.where(top > 0, large, small) * top + slack
        low = norms * np.where(bottom > 0, small, large) * bottom - slack
    return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)  # beyond all floats: no bound


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Vectors, pa.RecordBatch]]:
    """(group, kind, rows, batch) of each run of rows of one group and kind, cut to blocks."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        q = _matrix(column["q"]).astype(np.float32)
        if column["w"].null_count < batch.num_rows:
            wide = _matrix(column["w"])
            width = max(q.shape[1], wide.shape[1])
            is_wide = column["w"].is_valid().to_numpy(zero_copy_only=False)
            q = np.where(is_wide[:, None], _widened(wide, width), _widened(q.astype(np.float64), width))
        rows = Vectors(*(column[c].to_numpy() for c in ("vec_id", "label")), q, column["norm"].to_numpy(), _matrix(column["angles"]))
        group, kind = (column[c].to_numpy() for c in ("group", "kind"))
        starts = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
        for a, b in zip(starts, [*starts[1:], len(group)], strict=True):
            step = BLOCK if kind[a] else b - a
            for i in range(a, b, step):
                j = min(i + step, b)
                yield int(group[a]), int(kind[a]), rows[i:j], batch.slice(i, j - i)


def _joined(parts: list[Vectors]) -> Vectors:
    width = max(p.q.shape[1] for p in parts)
    q = np.concatenate([_widened(p.q, width) for p in parts])
    return Vectors(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("ids", "labels")), q, *(np.concatenate([getattr(p, c) for p in parts]) for c in ("norms", "angles")))


def _share(scores: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` of each integer score, rounded up or down, without a product beyond 64 bits."""
    whole, rest = scores // 100, scores % 100 * percent
    return whole * percent + (-(-rest // 100) if up else rest // 100)


def best_rows(indexed: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, same: bool, k: int, percents: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, slot, id, score, rank): the first ``k`` rows of each window of each anchor.

    With ``same``, rows of the anchor's label and one window without ends; else
    rows of other labels and a window for each of the anchor's
    ``positive_scores``, from and to ``percents`` of it.
    """
    spark = indexed.sparkSession
    n_a = max(1, math.ceil(n_anchors / ANCHORS))
    n_r = max(1, math.ceil(n_rows / ROWS), min(math.ceil(spark.sparkContext.defaultParallelism / n_a), math.ceil(n_rows / 5000)))
    columns = ["vec_id", "label", "q", "w", "norm", "angles", "cell", "near"]
    far = F.lit(None).cast("array<long>") if "positive_scores" not in anchors.columns else F.col("positive_scores")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))
    left = anchors.select(*columns, far.alias("positive_scores"), F.pmod(F.xxhash64("vec_id"), F.lit(n_a)).cast("int").alias("a"), numbers.alias("r"), F.lit(0).alias("kind"))
    right = indexed.select(
        *columns, F.lit(None).cast("array<long>").alias("positive_scores"), F.explode(F.sequence(F.lit(0), F.lit(n_a - 1))).alias("a"),
        F.pmod("row", F.lit(n_r)).cast("int").alias("r"), F.lit(1).alias("kind"),
    )
    dealt = left.unionByName(right).withColumn("group", (F.col("a") * n_r + F.col("r")).cast("int")).drop("a", "r")
    order: list[Column | str] = ["group", "kind", *(["label"] if same else []), "cell", "near"]
    dealt = dealt.repartitionById(n_a * n_r, F.col("group")).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, far_scores, search = None, [], [], None
        for group, kind, rows, batch in _groups(batches):
            if group != current:
                yield from _results(search)
                current, waiting, far_scores, search = group, [], [], None
            if kind == 0:
                waiting.append(rows)
                far_scores += batch.column(batch.schema.names.index("positive_scores")).to_pylist()
            elif waiting or search:
                if search is None:
                    search = Search(_joined(waiting), *_windows(far_scores, same, percents), same, k)
                    waiting, far_scores = [], []
                search.meet(rows)
        yield from _results(search)

    found = dealt.mapInArrow(run, "anchor_id long, slot int, id long, score long")
    first = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _windows(positive_scores: list, same: bool, percents: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each anchor's windows; where it has fewer than others, the rest are empty."""
    if same:
        ends = np.full((len(positive_scores), 1), np.inf)
        return -ends, ends
    width = max(map(len, positive_scores))
    low, high = (np.full((len(positive_scores), width), x) for x in (np.inf, -np.inf))
    for i, scores in enumerate(positive_scores):
        own = np.array(scores, dtype=np.int64)
        low[i, : len(own)], high[i, : len(own)] = _share(own, percents[0], True), _share(own, percents[1], False)
    return low, high


def _results(search: Search | None, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    if search is None:
        return
    anchor, slot, ids, scores = search.found()
    for i in range(0, len(anchor), rows):
        at = slice(i, i + rows)
        columns = [pa.array(search.anchors.ids[anchor[at]]), pa.array(slot[at], pa.int32()), pa.array(ids[at]), pa.array(scores[at])]
        yield pa.record_batch(columns, ["anchor_id", "slot", "id", "score"])


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percents: tuple[int, int] = (80, 100), scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows(vec_id, label, embedding)``; ``anchor`` says which of them are anchors.
    A score is the integer inner product of scaled components (see
    :func:`index` for rows that take no part); shorter vectors count as if they
    ended in zeros. Higher scores come first, ties by smaller vec_id. Positives
    are an anchor's first other rows of its label; for each, the negatives are
    the first rows of other labels whose score is between ``percents`` of the
    positive's.

    Repeated rows each count as rows. A row with the anchor's vec_id is not one of
    the others, and of several anchors with one vec_id the one of the least
    label and components stands. Anchors without positives, positives without
    negatives and empty tables give no rows. Scores are exact below 2 ** 63.
    """
    indexed = cut(index(rows, directions(rows), scale), "angles")
    own = F.struct("label", "q", "w", "norm", "angles", "cell", "near")
    anchors = indexed.where(anchor).groupBy("vec_id").agg(F.min(own).alias("v")).select("vec_id", "v.*")
    n_rows, n_anchors = indexed.agg(F.count(F.lit(1)), F.count_if(anchor)).first()

    near = best_rows(indexed, anchors, n_rows, n_anchors, True, positives)
    near = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    near = cut(near.select(F.col("anchor_id").alias("vec_id"), F.col("p.id").alias("positive_ids"), F.col("p.score").alias("positive_scores")), "positives")
    chosen = anchors.join(near, "vec_id")
    hard = best_rows(indexed, chosen, n_rows, n_anchors, False, negatives, percents)
    slots = near.select(F.col("vec_id").alias("anchor_id"), F.posexplode(F.arrays_zip("positive_ids", "positive_scores")).alias("slot", "p"))
    return hard.join(slots, ["anchor_id", "slot"]).select(
        "anchor_id", F.col("p.positive_ids").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("p.positive_scores").alias("positive_score"), F.col("score").alias("negative_score"),
    )
