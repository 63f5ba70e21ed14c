"""Toxicity scores from a small convolutional text classifier trained in numpy.

Words are hashed to buckets with an embedding each; filters of several widths
slide over the words, each keeps its largest response in the document, and a
logistic layer reads those maxima. A language is guessed from the words of the
text, and the decision threshold of that language, calibrated on rows of the
sample that no weight was fitted to, is moved to a score of 0.5.

The fit reads a bounded sample: at most ``max_rows`` labelled documents, chosen
by a hash of doc_id, as many whole ones of them as have ``max_chars`` characters
together, never those that are held out. Scoring reads every whole text.

Edge cases: null text is the empty text and scores like it; repeated rows score
alike; a document labelled more than once counts with its largest label; null
labels are left out; without both classes among the labels every score is the
share of the larger class's label moved inside (0, 1); other columns are kept
out of the score.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out

WORDS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 24
WIDTHS = (1, 2, 3)
# Frequent words of four languages, for the language guess only.
LANGUAGES = {
    "en": "the of and to in is that it for was on are with as be at this from by".split(),
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine".split(),
    "fr": "le la les et des du une dans est que pour qui par sur avec au plus pas".split(),
    "es": "el la los las de que y en un una por con para del se su al lo como".split(),
}


STEM = 5  # letters by which rare words share an embedding
APART, LEAST_APART = 5, 500  # every fifth row of a sample of so many is kept for the thresholds
SLICE = 256  # rows of a batch of scores
SAMPLE = pa.schema([("text", pa.string()), ("label", pa.int32())])


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def stem(word: str) -> int:
    return bucket(word[:STEM] + "-")


@dataclass
class Model:
    rows: dict[int, int]  # bucket of a word or stem -> row of the embedding; row 0 is any other
    embedding: np.ndarray  # rows x D
    filters: dict[int, np.ndarray]  # width -> width x D x K
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    language: np.ndarray  # first rows x languages: votes
    thresholds: np.ndarray  # logit of the threshold: a language each, then none

    def __post_init__(self) -> None:
        # each filter column applied to each embedding row, once
        self.tables = {w: [np.ascontiguousarray(self.embedding @ self.filters[w][j], dtype=np.float32) for j in range(w)] for w in WIDTHS}
        self.memo: _Rows = _Rows(self.rows)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("tables", "memo")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def ids(self, text: str | None) -> np.ndarray:
        """Embedding rows of a text's words, with a pad on either side."""
        get = self.memo.__getitem__
        return np.array([0, *map(get, WORDS.findall((text or "").lower())), 0, 0], np.int32)

    def logits(self, ids: list[np.ndarray]) -> np.ndarray:
        """Raw logits less the threshold of the guessed language."""
        out = np.empty(len(ids))
        for k, x in enumerate(ids):
            pooled = []
            for w in WIDTHS:
                n = len(x) - w + 1
                r = self.tables[w][0][x[:n]]
                for j in range(1, w):
                    r = r + self.tables[w][j][x[j : j + n]]
                pooled.append(np.maximum(r.max(axis=0) + self.bias[w], 0))
            out[k] = np.concatenate(pooled) @ self.out + self.out_bias - self.thresholds[self.guess(x)]
        return out

    def guess(self, ids: np.ndarray) -> int:
        votes = np.bincount(ids[ids < len(self.language)], minlength=len(self.language)) @ self.language
        return int(votes.argmax()) if votes.any() else len(LANGUAGES)


class _Rows(dict):
    def __init__(self, rows: dict[int, int], most: int = 150_000):
        self.rows, self.most = rows, most

    def __missing__(self, word: str) -> int:
        row = self.rows.get(bucket(word)) or self.rows.get(stem(word), 0)
        if len(self) >= self.most:
            self.clear()
        self[word] = row
        return row


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def train(texts: list[str], labels: np.ndarray, dim: int = 8, filters: int = 4, seed: int = 7) -> Model:
    """Fit on the rows given: labels 0 or 1."""
    rng = np.random.default_rng(seed)
    every, own = texts, np.asarray(labels, float)
    apart = np.arange(len(texts)) % APART == 0  # for the thresholds; the order is that of a hash
    if len(texts) < LEAST_APART or not 0 < own[apart].sum() < apart.sum():
        apart[:] = False
    texts, labels = [t for t, a in zip(every, apart, strict=True) if not a], own[~apart]
    n = len(texts)
    least = 5 if n >= 1000 else 3  # documents that a word or stem needs for a row of its own
    epochs = max(6, min(20, 20_000 // max(n, 1)))
    found = [set(WORDS.findall((text or "").lower())) for text in texts]
    common = {w for w, c in Counter(w for ws in found for w in ws).items() if c >= least}
    seen, positive = Counter(), Counter()
    for words, label in zip(found, labels, strict=True):
        buckets = {bucket(w) if w in common else stem(w) for w in words}
        seen.update(buckets)
        if label:
            positive.update(buckets)
    votes = {bucket(w): [float(w in words) for words in LANGUAGES.values()] for ws in LANGUAGES.values() for w in ws}
    kept = [*votes, *sorted(b for b, c in seen.items() if c >= least and b not in votes)]
    rows = {b: i + 1 for i, b in enumerate(kept)}
    pos = max(labels.sum(), 0.5)
    neg = max(n - labels.sum(), 0.5)
    # first dimension: how far the word's documents lean to either class
    embedding = rng.normal(0, 0.05, (len(kept) + 1, dim))
    embedding[0] = 0
    for b, i in rows.items():
        p, q = positive[b], seen[b] - positive[b]
        lean = math.log((p + 0.5) / (pos + 1)) - math.log((q + 0.5) / (neg + 1))
        embedding[i, 0] = max(-1.0, min(3.0, lean * (1 - 1 / math.sqrt(seen[b] + 1))))
    kernel = {w: rng.normal(0, 0.1, (w, dim, filters)) for w in WIDTHS}
    for w in WIDTHS:
        kernel[w][0, 0, 0] = 1.0
        for j in range(w):
            kernel[w][j, 0, min(1, filters - 1)] = 1.0 / w**0.5
    bias = {w: np.zeros(filters) for w in WIDTHS}
    weights = rng.normal(0, 0.1, len(WIDTHS) * filters)
    weights[::filters] = 0.5
    prior = math.log((pos + 0.5) / (neg + 0.5))
    language = np.zeros((len(votes) + 1, len(LANGUAGES)))  # their rows come first
    for b, v in votes.items():
        language[rows[b]] = v
    model = Model(rows, embedding, kernel, bias, weights, prior, language, np.zeros(len(LANGUAGES) + 1))
    ids = [model.ids(t) for t in texts]
    if 0 < labels.sum() < n:
        _descend(model, ids, labels, epochs, rng)
        model.__post_init__()
        if apart.any():
            ids, labels = [model.ids(t) for t, a in zip(every, apart, strict=True) if a], own[apart]
        _calibrate(model, ids, labels)
    return model


def _descend(model: Model, ids: list[np.ndarray], labels: np.ndarray, epochs: int, rng, batch: int = 32, rate: float = 0.003, decay: float = 1e-4) -> None:
    """Adam on the logistic loss; each maximum passes its gradient to one window."""
    params = {"E": model.embedding, "o": model.out, "c": np.array([model.out_bias])}
    params |= {f"f{w}": model.filters[w] for w in WIDTHS} | {f"b{w}": model.bias[w] for w in WIDTHS}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    filters, t = len(model.bias[1]), 0
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for at in range(0, len(order), batch):
            grads = {k: np.zeros_like(v) for k, v in params.items()}
            part = order[at : at + batch]
            tables = {w: [params["E"] @ params[f"f{w}"][j] for j in range(w)] for w in WIDTHS}
            for k in part:
                x, pooled, where = ids[k], [], []
                for w in WIDTHS:
                    n = len(x) - w + 1
                    r = sum(tables[w][j][x[j : j + n]] for j in range(w)) + params[f"b{w}"]
                    a = r.argmax(axis=0)
                    where.append(a)
                    pooled.append(r[a, np.arange(filters)])
                raw = np.concatenate(pooled)
                h = np.maximum(raw, 0)
                err = (float(sigmoid(h @ params["o"] + params["c"][0])) - labels[k]) / len(part)
                grads["o"] += err * h
                grads["c"] += err
                back = err * params["o"] * (raw > 0)
                for i, w in enumerate(WIDTHS):
                    g = back[i * filters : (i + 1) * filters]
                    grads[f"b{w}"] += g
                    for j in range(w):
                        row = x[where[i] + j]
                        grads[f"f{w}"][j] += model_outer(params["E"][row], g)
                        np.add.at(grads["E"], row, (params[f"f{w}"][j] * g).T)
            t += 1
            for k, p in params.items():
                g = grads[k] + decay * p
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
            params["E"][0] = 0
    model.out_bias = float(params["c"][0])


def model_outer(rows: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Column k is the embedding under filter k's maximum times its gradient."""
    return rows.T * g


def _best(logits: np.ndarray, labels: np.ndarray) -> float:
    """Middle of the gap that gives the largest F1."""
    order = np.argsort(-logits, kind="stable")
    hits = labels[order].cumsum()
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    i = int(f1.argmax())
    ranked = logits[order]
    return float((ranked[i] + ranked[i + 1]) / 2 if i + 1 < len(ranked) else ranked[i] - 0.5)


def _calibrate(model: Model, ids: list[np.ndarray], labels: np.ndarray, least: int = 20) -> None:
    """A threshold for each guessed language with enough labels of both kinds; else the common one."""
    logits = model.logits(ids)
    guesses = np.array([model.guess(x) for x in ids])
    common = _best(logits, labels)
    thresholds = np.full(len(LANGUAGES) + 1, common)
    for k in range(len(LANGUAGES) + 1):
        own = guesses == k
        if least <= labels[own].sum() <= own.sum() - least:
            thresholds[k] = _best(logits[own], labels[own])
    model.thresholds = thresholds


def labelled(labels: DataFrame, name: str, max_rows: int) -> DataFrame:
    """(doc_id, label) of at most ``max_rows`` documents that are not held out, by a hash of the id."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(name).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("long")), "doc_id")
        .limit(max_rows)
    )


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 6000, max_chars: int = 64_000_000) -> Model:
    sample = labelled(labels, "toxic", max_rows)  # bounded by max_rows: small enough to broadcast
    rows = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .groupBy(F.xxhash64("text").alias("h"))
        .agg(F.max_by(F.struct("text", "label"), "doc_id").alias("r"))
        .orderBy("h")
        .limit(max_rows)
        .withColumn("chars", F.sum(F.length("r.text")).over(Window.orderBy("h")))  # max_rows rows at most
        .where(F.col("chars") <= max_chars)
        .select("r.*")
    )

    # the sample is one sorted partition by now; it is fitted there, and the driver gets the weights only
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pa.Table.from_batches(batches, SAMPLE)
        model = train(own.column("text").to_pylist(), (own.column("label").to_numpy() > 0).astype(float))
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    fitted = rows.coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else train([], np.zeros(0))  # an empty sample may have no task


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``documents`` plus held_out, score and predicted."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a few hundred KB: words of the bounded sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):  # whole rows come back, in small batches
                batch = whole.slice(at, SLICE)
                logits = np.array([own.logits([own.ids(x.as_py())])[0] for x in batch.column("text")], float)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sigmoid(logits))], [*batch.schema.names, "score"])

    base = documents.drop("score", "held_out", "predicted")
    out = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType())])
    return (
        base.mapInArrow(run, out)
        .withColumn("held_out", held_out(F.col("doc_id")))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
