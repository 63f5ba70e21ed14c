"""N-gram Jaccard join of documents as a blocked sparse matrix product.

A document's set is its distinct shingles of five words; two documents link
when their sets' Jaccard similarity is at least 0.75. Equal sets are one class,
joined once. In a global order of shingles, rare before frequent, two linked
sets share a shingle within a prefix whose length the set's size gives, so only
prefixes enter the product. Its column blocks are hash partitions of the
shingles: a task multiplies the block with its transpose, discards pairs whose
sizes bound their similarity too low, and adds up partial overlaps; pairs whose
prefixes overlap less than their sizes demand are discarded, and those left are
verified on whole sets.

Shingles that many prefixes hold (boilerplate, large groups of near copies) do
not enter a block, as all pairs within would be too many. Sets with such a
shingle in their prefix have all their other shingles in it too, so a pair that
shares any other shingle still meets in a block. The rest can only overlap in
frequent shingles. Sets are grouped by the components of frequent shingles; in
each group all are compared with a few leaders, those made of frequent
shingles most. Leaders that link with one set are one part of the group; sets
outside its largest part are compared in bounded tiles with all of other parts
that have frequent shingles enough. So no link that joins two components is
lost, though links within a component need not be listed.

Edge cases: null and empty texts, and texts of white space, have no shingles
and link with nothing; a text of one to four words has one shingle, the whole
sequence; rows of equal text share their component; null ids take part and are
never the smallest; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, components, cut
from .words import by_key, keyed

N = 5  # words of a shingle
NUM, DEN = 75, 100  # similarity
FREQUENT = 8  # prefixes that make a shingle frequent
MOST_FREQUENT = 500_000  # shingles in the frequent list at most: 8 MB; others are joined in blocks as they are
NODES_BROADCAST = 1_000_000  # sets to verify whose keys may be broadcast: 8 MB
LEADERS = 3
TILE = 512
PAIRS_HELD = 300_000  # pairs that a task holds before it sums them up
#: Shingles are counted by the upper 48 bits of their hash, which take a sixth less room in the shuffle. Those that share them are
#: frequent together: that changes the way by which their sets are compared, not what links.
SHORT = np.uint64(16)


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


class _Powers:
    """Powers of BASE and of its inverse modulo 2**64, as many as the longest text so far has bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            powers = np.full(size + 1, base, np.uint64)
            powers[0] = 1
            setattr(self, name, np.cumprod(powers))

    def words(self, text: bytes) -> np.ndarray:
        """A polynomial hash for each word of a text, all at once."""
        data = np.frombuffer(text, np.uint8)
        n = len(data)
        if len(self.up) <= n:
            self.grow(n)
        edge = np.flatnonzero(np.diff(SPACE[data], prepend=True, append=True))
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(np.multiply(data, self.up[:n], dtype=np.uint64), out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, powers: _Powers) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    # bytes: A-Z alone change, ASCII white space alone splits
    h = powers.words((text or "").encode().lower())
    if not len(h):
        return np.empty(0, np.uint64)
    h = _mix(h)
    size = min(N, len(h))
    last = len(h) - size + 1
    out = np.full(last, size, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + h[i : i + last]
    out = np.sort(_mix(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def prefix_length(n: int) -> int:
    """Of a set of n: linked sets share a shingle within their prefixes."""
    return n - (NUM * n + DEN - 1) // DEN + 1 if n else 0


def needed(na, nb):
    """Least overlap of linked sets of these sizes."""
    return (NUM * (na + nb) + NUM + DEN - 1) // (NUM + DEN)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    same = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * same >= NUM * (len(a) + len(b) - same) and same > 0


def _fingerprint(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _longs(arrays: list) -> pa.Array:
    """ListArray of int64 from arrays of uint64, None for null."""
    sizes = np.array([0 if a is None else len(a) for a in arrays], np.int64)
    offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
    whole = [a for a in arrays if a is not None]
    values = np.concatenate(whole).view(np.int64) if whole else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array([a is None for a in arrays]))


def _often(documents: DataFrame, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of at least FREQUENT sets, shortened and sorted, and of how many; MOST_FREQUENT at most.

    Without ``known`` only those in prefixes by hash order count; with it, all
    others beyond that prefix, of sets with a known shingle in it.
    """
    shared = documents.sparkSession.sparkContext.broadcast(known)  # bounded by MOST_FREQUENT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen, known = _Powers(), set(), shared.value
        for batch in batches:
            out = []
            for text in batch.column(0):
                s = shingle_set(text.as_py(), powers)
                if not len(s) or (f := _fingerprint(s)) in seen:
                    continue
                seen.add(f)
                p = prefix_length(len(s))
                if known is None:
                    out.append(s[:p])
                elif (there := _among(known, s)[1])[:p].any():
                    out.append(s[p:][~there[p:]])  # those before were counted
            if out:
                yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(out) >> SHORT).view(np.int64))], ["g"])

    found = (
        documents.select("text").mapInArrow(run, "g long").groupBy("g").count().where(F.col("count") >= FREQUENT)
        .orderBy(F.desc("count"), "g").limit(MOST_FREQUENT).toPandas()
    )
    tokens = found["g"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found["count"].to_numpy(np.int64)[order]


def _among(known: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``known``, shortened and sorted, each of ``s`` would be, and whether it is there."""
    s = s >> SHORT
    if not len(known):
        return np.zeros(len(s), np.int64), np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
    return at, known[at] == s


def _frequent(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles, shortened and sorted, and how many sets they are in.

    Two counts over all documents: of prefixes, and, of the sets whose prefix
    holds a shingle frequent by the first, of all beyond the prefix. Any other
    shingle is then in fewer than FREQUENT first prefixes and in fewer than FREQUENT
    sets that may have it in a later one: blocks stay small, however alike the sets are.
    """
    first = _often(documents, None)
    if not len(first[0]):
        return first
    second = _often(documents, first[0])
    tokens, counts = np.concatenate([first[0], second[0]]), np.concatenate([first[1], second[1]])
    order = np.lexsort((-counts, tokens))
    tokens, counts = tokens[order], counts[order]
    keep = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    return tokens[keep], counts[keep]


ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("h", T.LongType()),
        T.StructField("fp", T.StringType()),
        T.StructField("f1", T.LongType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("cold", T.ArrayType(T.LongType())),
        T.StructField("hot", T.ArrayType(T.LongType())),
        T.StructField("n_hot", T.IntegerType()),
        T.StructField("s", T.BinaryType()),
    ]
)


def _rows(documents: DataFrame, tokens: np.ndarray, counts: np.ndarray) -> DataFrame:
    """A row for each document: fingerprint and size of its set, prefix in the order of rarity.

    Prefixes and, where a frequent shingle is in the prefix, whole sets come
    once for each set and task.
    """
    shared = documents.sparkSession.sparkContext.broadcast((tokens, counts))  # bounded by MOST_FREQUENT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = _Powers(), set()
        tokens, counts = shared.value
        for batch in batches:
            rows = []
            for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = shingle_set(text.as_py(), powers)
                f = _fingerprint(s)
                key = (doc_id, h, f.hex(), int.from_bytes(f[:8], "little", signed=True), len(s))
                if not len(s) or f in seen:
                    rows.append((*key, None, None, 0, None))
                    continue
                seen.add(f)
                p = prefix_length(len(s))
                at, is_hot = _among(tokens, s)
                cold, n_hot = s[~is_hot], int(is_hot.sum())
                hot = None
                if len(cold) < p:
                    own = s[is_hot]
                    hot = own[np.argsort(counts[at[is_hot]], kind="stable")][: p - len(cold)]
                rows.append((*key, cold[:p], hot, n_hot, None if hot is None else s.tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int32()), _longs(columns[5]), _longs(columns[6]),
                    pa.array(columns[7], pa.int32()), pa.array(columns[8], pa.binary()),
                ],
                ROWS.names,
            )

    return keyed(documents).select(F.col("doc_id").cast("long"), "h", "text").mapInArrow(run, ROWS)


def _products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within a block of shingles and their overlap in it: columns g, f1, n, rest in; a, b, lack, overlap out.

    ``lack`` is how much the whole entries of a pair must overlap.
    """
    parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
    if not parts:
        return
    g, f, n, rest = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((f, g))
    g, f, n, rest = g[order], f[order], n[order].astype(np.int64), rest[order].astype(np.int64)
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (f[1:] != f[:-1])  # a set that several tasks gave
    g, f, n, rest = g[keep], f[keep], n[keep], rest[keep]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(g)]]))
    held: list[np.ndarray] = []
    total = 0

    def pairs(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        ni, nj = n[i], n[j]
        need = needed(ni, nj)
        ok = DEN * np.minimum(ni, nj) >= NUM * np.maximum(ni, nj)
        return np.stack([f[i[ok]], f[j[ok]], (need - np.maximum(rest[i], rest[j]))[ok]], axis=1)

    def summed() -> pa.RecordBatch:
        both = np.concatenate(held)
        order = np.lexsort((both[:, 1], both[:, 0]))
        both = both[order]
        first = np.concatenate([[True], (both[1:] != both[:-1]).any(axis=1)])
        at = np.flatnonzero(first)
        overlap = np.diff(np.concatenate([at, [len(both)]])).astype(np.int32)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(both[at, 0]), pa.array(both[at, 1]), pa.array(both[at, 2].astype(np.int32)), pa.array(overlap)], ["a", "b", "lack", "overlap"])

    for size in np.unique(sizes[sizes > 1]):
        own = starts[sizes == size]
        for row in range(1, size):  # every run of this size at once: its row-th set with the sets before
            step = max(1, PAIRS_HELD // row)
            for at in range(0, len(own), step):
                base = own[at : at + step]
                j = np.repeat(base + row, row)
                i = (base[:, None] + np.arange(row)[None, :]).ravel()
                found = pairs(i, j)
                if len(found):
                    held.append(found)
                    total += len(found)
                if total >= PAIRS_HELD:
                    yield summed()
                    total = 0
    if held:
        yield summed()


def _sets(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """(f1, fp, s) of the sets of the texts whose hash is among ``nodes(h)``."""
    few = nodes.limit(NODES_BROADCAST + 1).count() <= NODES_BROADCAST

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = _Powers(), set()
        for batch in batches:
            rows = []
            for text in batch.column(0):
                s = shingle_set(text.as_py(), powers)
                f = _fingerprint(s)
                if f not in seen:
                    seen.add(f)
                    rows.append((int.from_bytes(f[:8], "little", signed=True), f.hex(), s.tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary())], ["f1", "fp", "s"])

    texts = keyed(documents).select("h", "text").join(F.broadcast(nodes) if few else nodes, "h", "left_semi")
    return texts.select("text").mapInArrow(run, "f1 long, fp string, s binary").dropDuplicates(["fp"])


def _verified(pairs: DataFrame) -> DataFrame:
    """(a, b) of ``pairs(a, b, sa, sb)`` whose sets link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [
                linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a string, b string")


def _cold_edges(documents: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    entries = rows.where("cold is not null").select("f1", "n", (F.col("n") - F.size("cold")).alias("rest"), F.explode("cold").alias("g"))
    partial = entries.select("g", "f1", "n", "rest").repartition("g").mapInArrow(_products, "a long, b long, lack int, overlap int")
    # of linked sets, the one whose entries end first overlaps with the other in
    # these and in what it did not enter: entries must share what that cannot give
    pairs = partial.groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.max("lack").alias("lack"))
    pairs = scratch.cut(pairs.where("overlap >= lack").select("a", "b"), "pairs")
    nodes = pairs.select(F.col("a").alias("f1")).union(pairs.select("b")).distinct()
    nodes = scratch.cut(rows.where("cold is not null").select("f1", "h").join(nodes, "f1", "left_semi").select("h").distinct(), "nodes")
    sets = scratch.cut(_sets(documents, nodes), "sets")
    left = sets.select(F.col("f1").alias("a"), F.col("fp").alias("fa"), F.col("s").alias("sa"))
    right = sets.select(F.col("f1").alias("b"), F.col("fp").alias("fb"), F.col("s").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    return _verified(both.select(F.col("fa").alias("a"), F.col("fb").alias("b"), "sa", "sb"))


def _tiles(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between a tile of sets outside the largest part of a group and a tile of all its sets, of different parts or none."""
    out: list[tuple[str, str]] = []
    if left.num_rows and right.num_rows:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in right.column("s")]
        flat, ends = np.concatenate(sets), np.cumsum([len(x) for x in sets])
        sizes, hot = np.array([len(x) for x in sets]), right.column("n_hot").to_numpy()
        names, parts = right.column("fp").to_pylist(), right.column("part").to_numpy()
        for fp, s, h, part in zip(left.column("fp").to_pylist(), left.column("s"), left.column("n_hot").to_pylist(), left.column("part").to_pylist(), strict=True):
            s = np.frombuffer(s.as_buffer(), np.uint64)
            near = (np.minimum(h, hot) >= needed(len(s), sizes)) & (DEN * np.minimum(len(s), sizes) >= NUM * np.maximum(len(s), sizes))
            near &= (parts != part) | (part == 0)
            if not near.any():
                continue
            at = np.minimum(np.searchsorted(s, flat), len(s) - 1)
            sums = np.concatenate([[0], np.cumsum(s[at] == flat)])
            same = sums[ends] - sums[ends - sizes]
            for k in np.flatnonzero(near & (DEN * same >= NUM * (len(s) + sizes - same))):
                if names[k] != fp:
                    out.append((fp, names[k]))
    return pa.table({"a": pa.array([a for a, _ in out], pa.string()), "b": pa.array([b for _, b in out], pa.string())})


def _hot_edges(rows: DataFrame, scratch: Scratch) -> DataFrame | None:
    hot = rows.where("hot is not null")
    first = F.array_min("hot")
    together = components(hot.select(first.alias("a"), F.explode("hot").alias("b")))
    # a group is the component of frequent shingles that a set's prefix holds
    hot = hot.select(first.alias("node"), "fp", "n", "n_hot", "s").dropDuplicates(["fp"]).join(together, "node", "left")
    hot = scratch.cut(hot.select(F.coalesce("root", "node").alias("grp"), "fp", "n", "n_hot", "s"), "groups")
    if hot.isEmpty():
        return None
    edges, left = None, hot.drop("s")
    marks = None
    for i in range(LEADERS):
        rank = F.struct(F.col("n_hot") / F.col("n"), "n", "fp")
        chosen = left.groupBy("grp").agg(F.max_by("fp", rank).alias("fp"))
        leaders = hot.select("fp", F.col("s").alias("sa")).join(chosen, "fp").select("grp", F.col("fp").alias("a"), "sa")
        pairs = hot.join(leaders, "grp").select("a", F.col("fp").alias("b"), "sa", F.col("s").alias("sb"))
        found = scratch.cut(_verified(pairs), "leader-links")  # a leader links with itself, and so leaves the rest
        edges = found if edges is None else edges.unionByName(found)
        mark = found.select(F.col("b").alias("fp"), F.lit(1 << i).alias("mask"))
        marks = mark if marks is None else marks.unionByName(mark)
        left = scratch.cut(left.join(found.select(F.col("b").alias("fp")), "fp", "left_anti"), "unlinked")
    # a part: the leaders, as bits, that sets linked with several of them join; 0 without a leader
    enough = F.col("n_hot") * DEN >= F.col("n") * NUM
    marks = marks.groupBy("fp").agg(F.bit_or("mask").alias("mask"))
    able = scratch.cut(hot.select("grp", "fp", "n", "n_hot").join(marks, "fp", "left").select("grp", "fp", enough.alias("able"), F.coalesce("mask", F.lit(0)).alias("mask")), "masks")
    part = F.col("mask")
    for _ in range(LEADERS):
        part = F.aggregate("masks", part, lambda x, m: F.when(x.bitwiseAND(m) != 0, x.bitwiseOR(m)).otherwise(x))
    masks = able.groupBy("grp").agg(F.collect_set("mask").alias("masks"))
    able = able.where("able").join(masks, "grp").select("grp", "fp", part.alias("part"))
    able = scratch.cut(able, "parts")
    most = able.where("part > 0").groupBy("grp", "part").count().groupBy("grp").agg(F.max_by("part", F.struct("count", "part")).alias("most"))
    outside = able.join(most, "grp", "left").where("most is null or part <> most").select("grp", "fp", "part")
    outside = scratch.cut(outside, "outside")
    # sets outside the largest part, against all of its group that frequent shingles alone can link
    counts = able.groupBy("grp").agg((F.count(F.lit(1)) / TILE).cast("int").alias("right")).join(
        outside.groupBy("grp").agg((F.count(F.lit(1)) / TILE).cast("int").alias("left")), "grp"
    )
    sets = hot.where(enough).select("fp", "n_hot", "s")
    spread = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    x = outside.join(counts, "grp").join(sets, "fp").select(
        "grp", (spread % (F.col("left") + 1)).cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.col("right"))).alias("col"), "fp", "n_hot", "part", "s"
    )
    y = able.join(counts, "grp").join(sets, "fp").select(  # names of their own for columns that x has too
        F.col("grp").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("left"))).alias("row"), (spread % (F.col("right") + 1)).cast("int").alias("col"), *(F.col(c).alias(c) for c in ("fp", "n_hot", "part", "s"))
    )
    tiles = x.groupBy("grp", "row", "col").cogroup(y.groupBy("grp", "row", "col")).applyInArrow(_tiles, "a string, b string")
    return edges.unionByName(tiles)


def classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp, n) of all documents, and (fp, component_id) of all sets that are not empty."""
    scratch = Scratch(documents.sparkSession)
    whole = scratch.cut(_rows(documents, *_frequent(documents)), "rows")
    rows = cut(whole.select("doc_id", "h", "fp", "n"), "keys")
    edges = _cold_edges(documents, whole, scratch)
    hot = _hot_edges(whole, scratch)
    groups = components(edges if hot is None else edges.unionByName(hot))
    scratch.clear()  # prefixes and sets; what follows reads keys and components
    own = rows.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"))
    own = own.join(groups.select(F.col("node").alias("fp"), "root"), "fp", "left")
    own = cut(own.select("fp", F.coalesce("root", "fp").alias("root"), "least"), "classes")
    # only components of several sets are summed up; the others keep their own smallest id
    shared = groups.select("root").distinct()
    least = own.join(shared, "root", "left_semi").groupBy("root").agg(F.min("least").alias("m"))
    found = own.join(least, "root", "left").select("fp", F.coalesce("m", "least").alias("component_id"))
    return rows, found


def _components(documents: DataFrame) -> DataFrame:
    rows, found = classes(documents)
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(found, "fp", "left").select("doc_id", "h", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return _components(documents).select("doc_id", "n_shingles", "component_id")


def dedup(documents: DataFrame) -> DataFrame:
    """``documents`` with one row for each component: one of its smallest id; texts without words stay.

    Where rows of the smallest id have different texts, that of the smallest
    hash stays; of repeated rows, any one.
    """
    rows = cut(_components(documents.select("doc_id", "text")), "components").where("n_shingles > 0")
    out = rows.where("not (doc_id <=> component_id)").select("doc_id", "h")
    rest = rows.where("doc_id <=> component_id")
    several = rest.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.min("h").alias("first")).where("copies > 1")
    several = cut(several, "several")
    docs = keyed(documents, F.struct(*documents.columns).alias("row"))
    if not several.isEmpty():  # an id that stands for its component more than once
        more = rest.join(several, rest["doc_id"].eqNullSafe(several["doc_id"])).where("h <> first").select(rest["doc_id"], "h")
        out = out.unionByName(more)
        keys = several.select(F.col("doc_id").alias("_d"), F.col("first").alias("_f"))
        same = docs["doc_id"].eqNullSafe(F.col("_d")) & (docs["h"] == F.col("_f"))
        docs = docs.join(keys, same, "left_anti").unionByName(docs.join(keys, same, "left_semi").dropDuplicates(["doc_id", "h"]))
    gone = cut(out.distinct(), "copies")
    return by_key(docs.drop("text"), gone, "left_anti").select("row.*")
