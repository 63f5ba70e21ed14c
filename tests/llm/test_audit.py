"""The filter audit against a plain count of every document in every order."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from seqlake.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, mask int, n int, part string"


def failing(doc_id, text, rows):
    words = WORD.findall(text)
    tests = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
    )
    return {f for f, t in zip("ABCDE", tests, strict=True) if t}


def expected(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    parts = {}
    for i, text, lang in rows:
        parts.setdefault(lang or "", []).append((i, failing(i, text or "", rows)))
    out, shares = [], {}
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shares[part, f] = shares.get((part, f), 0) + len(gone)
                fails = sum(f in d[1] for d in docs)
                out.append((part, f, "".join(order), step, len(left), len(gone), fails - len(gone), sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)))
    return sorted((p, o, s, *rest, shares[p, f]) for p, f, o, s, *rest in out)


LONG = " ".join(f"w{i}" for i in range(300))
ROWS = [
    (1, None, None), (2, "", ""), (3, "  \n", "en"), (4, LONG, "en"), (5, LONG, "de"), (6, LONG + " #", "en"), (7, "a b " * 300, "en"), (7, "a b " * 300, "en"),
    (8, "a b " * 300, None), (9, "ÀÉ Abc x", "de"), (None, LONG, "en"), (None, "", "en"), (10, LONG.upper(), "de"), (11, "x y\x85z " * 200, "de"), (12, "A" * 50_000, "de"), (2, "", "en"),
]
LABELS = [(4, 1, 0), (4, 0, 1), (5, 1, None), (7, None, 1), (8, 1, 1), (10, 0, 0), (None, 1, 1), (99, 1, 1)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, 2, "p") for r in rows], SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(3))


def test_audit_against_brute_force(spark):
    got = sorted(tuple(r) for r in audit.report(*frames(spark, ROWS, LABELS)).collect())
    assert got == expected(ROWS, LABELS)


def test_audit_of_empty_tables(spark):
    assert audit.report(*frames(spark, [], LABELS)).count() == 0
    none = audit.report(*frames(spark, ROWS, [])).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(none) == (0, 0)


@pytest.mark.parametrize("n", range(6))
def test_plain_changes_meet_every_order_once(n):
    order, met = list(range(n)), {tuple(range(n))}
    for i in audit.plain_changes(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        assert tuple(order) not in met
        met.add(tuple(order))
    assert len(met) == len(list(itertools.permutations(range(n))))


def test_swapped_levels_count_the_same_documents():
    counts = {m: (m + 1, m % 3, m % 2) for m in range(16) if m % 5}
    diagram = audit.Diagram("ABCD", counts, 3)
    total = diagram.weight(diagram.root)
    for i in audit.plain_changes(4):
        diagram.swap(i)
        assert diagram.weight(diagram.root) == total
        fresh = audit.Diagram("".join(diagram.order), {sum(1 << k for k, f in enumerate(diagram.order) if m >> "ABCD".index(f) & 1): c for m, c in counts.items()}, 3)
        assert list(fresh.steps()) == list(diagram.steps())
