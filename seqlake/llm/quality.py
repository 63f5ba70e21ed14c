"""Document quality by a sparse ensemble of conjunctive rules.

Statistics of each whole text feed shallow trees grown on bootstraps of a
labelled sample. Every path from a root to a node is a rule, a conjunction of
comparisons on statistics; a logistic model with an L1 penalty weighs the rules
and drops most. The rules that stay are compiled into one Spark column
expression over the statistics.

The fit reads at most ``max_rows`` labelled documents, chosen by a hash of
doc_id, never those that are held out. Scoring reads every whole text.

Edge cases: null text is the empty text, whose statistics are all 0; repeated
rows score alike; a document labelled more than once counts with its largest
label; null labels are left out; without labels, or with one class only, every
score is the smoothed share of good labels; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out
from .toxicity import labelled, sigmoid

STATISTICS = (
    "n_words", "word_len", "upper_share", "digit_share", "symbol_share", "space_share", "ending_share",
    "distinct_words", "top_word_share", "line_len", "short_lines", "repeated_lines", "bar_share", "shout_share",
)
SYMBOLS = "#$%&*@|{}[]<>~^_=+\\/"

Rule = tuple[tuple[str, bool, float], ...]  # (statistic, is above, cut), all must hold


def statistics(text: str | None) -> list[float]:
    """One number for each of STATISTICS."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    upper = sum(w.isupper() for w in words)
    symbols = sum(map(text.count, SYMBOLS))
    digits = sum(map(text.count, "0123456789"))
    endings = text.count(".") + text.count("?") + text.count(";")
    return [
        float(n),
        sum(map(len, words)) / n,
        upper / n,
        digits / chars,
        symbols / chars,
        text.count(" ") / chars,
        endings / n,
        len(counts) / n,
        max(counts.values()) / n,
        chars / max(len(lines), 1),
        sum(len(x) < 30 for x in lines) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
        text.count("|") / n,
        text.count("!") / n,
    ]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, plus one double column for each of STATISTICS."""
    keep = [f for f in df.schema.fields if f.name != text and f.name not in STATISTICS]
    names = [f.name for f in keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(x.as_py()) for x in batch.column(text)], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], [*names, *STATISTICS]
            )

    return df.select(*names, text).mapInArrow(run, T.StructType([*keep, *(T.StructField(s, T.DoubleType()) for s in STATISTICS)]))


def grow(x: np.ndarray, y: np.ndarray, depth: int, tries: int, rng, path: Rule = ()) -> list[Rule]:
    """Paths of one tree: splits of least Gini impurity among ``tries`` random statistics."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return []
    best = None
    for j in rng.choice(x.shape[1], tries, replace=False):
        order = np.argsort(x[:, j], kind="stable")
        v, good = x[order, j], y[order].cumsum()
        n = np.arange(1, len(y))
        left = good[:-1]
        right = good[-1] - left
        impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
        impurity[(v[1:] <= v[:-1]) | (n < 5) | (len(y) - n < 5)] = np.inf
        i = int(impurity.argmin())
        if np.isfinite(impurity[i]) and (best is None or impurity[i] < best[0]):
            best = (impurity[i], int(j), float((v[i] + v[i + 1]) / 2))
    if best is None:
        return []
    _, j, cut = best
    above = x[:, j] > cut
    rules: list[Rule] = []
    for side in (False, True):
        own = (*path, (STATISTICS[j], side, cut))
        rules += [own, *grow(x[above == side], y[above == side], depth - 1, tries, rng, own)]
    return rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, above, cut in rule:
        out &= (x[:, STATISTICS.index(name)] > cut) == above
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic weights under an L1 penalty, by accelerated proximal gradient steps."""
    n, p = z.shape
    w = v = np.zeros(p)
    b = c = math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1)
    for k in range(1, rounds + 1):
        g = (sigmoid(z @ v + c) - y) / n
        w2 = v - step * (z.T @ g)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)
        b2 = c - step * g.sum()
        m = (k - 1) / (k + 2)
        v, c = w2 + m * (w2 - w), b2 + m * (b2 - b)
        w, b = w2, b2
    return w, float(b)


class Ensemble:
    def __init__(self, rules: list[Rule], weights: np.ndarray, bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def column(self) -> Column:
        """The score as a Spark expression over the statistics."""
        logit = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            test = F.lit(True)
            for name, above, cut in rule:
                test = test & ((F.col(name) > cut) if above else (F.col(name) <= cut))
            logit = logit + F.when(test, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            logit += weight * holds(rule, x)
        return sigmoid(logit)


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, seed: int = 11) -> Ensemble:
    y = np.asarray(y, float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble([], np.zeros(0), math.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        rules.update(dict.fromkeys(grow(x[rows], y[rows], depth, 5, rng)))
    found = list(rules)
    z = np.stack([holds(r, x) for r in found], axis=1).astype(float)
    _, first = np.unique(z, axis=1, return_index=True)
    found, z = [found[i] for i in sorted(first)], z[:, sorted(first)]
    weights, bias = lasso(z, y, penalty)
    kept = np.flatnonzero(weights)
    return Ensemble([found[i] for i in kept], weights[kept], bias)


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = 6000) -> Ensemble:
    sample = labelled(labels, "quality", max_rows)  # bounded by max_rows: small enough to broadcast
    rows = with_statistics(documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    # numbers only; ids may repeat in documents, so the bound is set again
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(max_rows).toPandas()
    return train(rows[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), (rows["label"].to_numpy() > 0).astype(float))


def score(documents: DataFrame, model: Ensemble, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistics of every document."""
    return (
        with_statistics(documents.select("doc_id", "text"))
        .withColumn("score", model.column())
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *STATISTICS)
    )
