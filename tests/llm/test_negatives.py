"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqlake.llm import negatives


def expected(rows, k=5, low=80, high=100, scale=256):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, label, [math.floor(scale * x) for x in v]))
    anchors = {}
    for i, label, q in sorted(kept, key=lambda r: r[0]):
        if i % 100 == 0 and (i not in anchors or (label, q) < anchors[i]):
            anchors[i] = (label, q)
    out = []
    for i, (label, q) in anchors.items():
        scores = [(-sum(a * b for a, b in zip(q, p, strict=False)), j, other) for j, other, p in kept if j != i]
        near = sorted((s, j) for s, j, other in scores if other == label)[:k]
        for s, j in near:
            hard = sorted((t, m) for t, m, other in scores if other != label and low * -s <= 100 * -t <= high * -s)[:k]
            out += [(i, j, n, m, -s, -t) for n, (t, m) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, kind="double", **options):
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v], label) for i, v, label in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns({c: F.lit(1) for c in ("q", "row", "norm", "slot")})
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **options).collect()))


def clustered(n, dims, seed, labels=4, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dims))
    return [(i, (centres[i % 6] + spread * r.normal(size=dims)).tolist(), int(r.integers(labels))) for i in range(n)]


ODD = [
    (700, None, 1), (701, [1.0, None], 1), (800, [float("nan"), 1.0], 2), (801, [float("inf"), 1.0], 2), (900, [0.1, 0.2], None), (None, [0.1], 1), (1000, [], 1),
    (1100, [0.0] * 8, 1), (1101, [0.0] * 8, 1), (1102, [0.0] * 8, 2), (1200, [0.5], 3), (1300, [1e5, -1e5, 3e4, 0, 0, 0, 0, 1.0], 1), (1301, [1e5, -1e5, 3e4, 0, 0, 0, 0, 1.0], 2), (1302, [9e4, -1e5, 3e4], 1),
    (1400, [1e300, 1.0], 1), (100, [0.3] * 8, 1), (100, [0.3] * 8, 1), (5, [0.3] * 8, 2), (5, [0.3] * 8, 2),
]


@pytest.mark.parametrize("blocks", [(512, 2048), (7, 3)])
def test_mining_against_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "AT_ONCE", blocks[1])
    rows = clustered(650, 8, 1) + [r for r in ODD if r[0] != 1400]
    assert mined(spark, rows) == expected(rows) != []


def test_groups_of_anchors_and_rows(spark, monkeypatch):
    rows = [(i * 10, v, label) for i, v, label in clustered(400, 6, 2)]
    monkeypatch.setattr(negatives, "ANCHORS", 11)
    monkeypatch.setattr(negatives, "ROWS", 90)
    assert mined(spark, rows) == expected(rows)
    assert mined(spark, rows, positives=3, negatives=3, percents=(50, 90)) == expected(rows, 3, 50, 90)


def test_many_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    r = random.Random(4)
    rows = [(i, [1.0, 0.5, -0.25] if i % 3 else [r.random() for _ in range(3)], i % 2 if i % 5 else 7) for i in range(900)]
    assert mined(spark, rows, "float") == expected(rows)


def test_vectors_that_are_not_finite_or_huge(spark):
    assert mined(spark, [r for r in ODD if r[0] != 1400]) == expected([r for r in ODD if r[0] != 1400])
    both = mined(spark, ODD)  # some scores with one row do not fit 64 bits: they are the largest or smallest long
    assert both and all(80 * p <= 100 * n <= 100 * p for *_, p, n in both)


def test_empty_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [0.5], 1), (2, [0.25], 2)]) == [] and mined(spark, [(100, None, 1)]) == []


def vectors(rows, refs):
    x = np.array([v for _, v, _ in rows])
    q = np.floor(256 * x)
    norms = np.linalg.norm(q, axis=1)
    angles = np.arccos(np.clip(q @ refs.T / norms[:, None], -1, 1)).astype(np.float32)
    return negatives.Vectors(np.array([r[0] for r in rows]), np.array([r[2] for r in rows]), q, norms, angles)


def test_bounds_hold_and_leave_blocks_out():
    rows = clustered(1200, 16, 5, spread=0.15)
    x = np.array([v for _, v, _ in rows])
    refs = x[:16] / np.linalg.norm(x[:16], axis=1, keepdims=True)
    every = vectors(rows, refs)
    for start in range(0, 1200, 100):
        block = every[np.arange(start, start + 100)]
        low, high = negatives.score_bounds(every.angles, every.norms, block)
        s = every.q @ block.q.T
        assert (low <= s.min(1)).all() and (s.max(1) <= high).all()
    order = np.lexsort((every.angles.min(1), every.angles.argmin(1)))
    anchors = every[np.arange(0, 1200, 100)]
    search = negatives.Search(anchors, np.full((12, 1), -np.inf), np.full((12, 1), np.inf), True, 5)
    for i in range(0, 1200, 50):
        search.meet(every[order[i : i + 50]])
    assert 0 < search.scored < 0.5 * 12 * 1200
