"""How filters interact: what each removes in every order of application, by decision diagrams.

Spark computes a failure mask for each document, finds duplicates by digests, and
counts masks within each part; texts are never shuffled. A part is then at most
2 ** filters counts: one small decision diagram, whose levels are the filters in
their order. Adjacent levels are swapped until every order was met, and the
path on which all filters pass gives each order's steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
NAMES = "ABCDE"
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, key, mask): bits 0 to 3 of each document's mask are the filters A to D that it fails.

    A: under 200 words; B: distinct words are under half of the words; C: over
    3 % of the code points are A-Z; D: one of ``#$%&*|`` occurs. Null texts
    count as empty, null languages as ''. ``key`` is the text's SHA-256.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    counted = read.select(
        "doc_id", "part", F.sha2("t", 256).alias("key"), F.size("w").cast("long").alias("n_words"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.regexp_count("t", F.lit("[A-Z]")).cast("long").alias("n_upper"), F.length("t").cast("long").alias("n_chars"), F.col("t").rlike("[#$%&*|]").alias("marked"),
    )
    fails = (F.col("n_words") < 200, F.col("n_distinct") * 100 < F.col("n_words") * 50, F.col("n_upper") * 100 > F.col("n_chars") * 3, F.col("marked"))
    return counted.select("doc_id", "part", "key", _bits(fails).alias("mask"))


def _bits(fails: tuple[Column, ...]) -> Column:
    mask = F.lit(0)
    for i, f in enumerate(fails):
        mask = mask + F.when(f, 1 << i).otherwise(0)
    return mask


def mask_counts(failed: DataFrame, labels: DataFrame, duplicate_bit: int = 4) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, with the bit of filter E where a smaller doc_id has the same text.

    Documents meet by text only as counts of (text, part, mask, labels), so a
    text that a third of all rows share is a few rows in the window. Rows with a
    null doc_id have no smaller one. A document is good or toxic if any of its
    rows in ``labels`` says 1.
    """
    marks = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    own = ["key", "part", "mask", "good", "toxic"]
    marked = failed.join(marks, "doc_id", "left").select("doc_id", "key", "part", "mask", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))
    ids = marked.groupBy("doc_id", *own).agg(F.count(F.lit(1)).alias("n"))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    groups = ids.groupBy(*own).agg(F.sum("n").alias("n"), F.min(named).alias("first"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    least = F.min("first.doc_id").over(Window.partitionBy("key"))
    groups = groups.withColumn("originals", F.col("unnamed") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0))
    split = F.explode(F.array(
        F.struct(F.col("mask").alias("m"), F.col("originals").alias("c")),
        F.struct((F.col("mask") + (1 << duplicate_bit)).alias("m"), (F.col("n") - F.col("originals")).alias("c")),
    ))
    rows = groups.select("part", "good", "toxic", split.alias("x")).select("part", F.col("x.m").alias("mask"), F.col("x.c").alias("n"), "good", "toxic")
    sums = (F.sum(F.col("n") * F.col(c)).alias(c) for c in ("good", "toxic"))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)


class Diagram:
    """A shared decision diagram: each level one filter, its pass and fail branches, count vectors as leaves.

    Equal subdiagrams are one node. No level is skipped, so that a node's weight,
    the sum of the leaves below it, counts documents.
    """

    def __init__(self, order: str, counts: Mapping[int, tuple[int, ...]], width: int):
        """``counts``: vectors of ``width`` counts by mask, bit i being the i-th filter of ``order``; absent masks count 0."""
        self.order = list(order)
        self.nodes: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.weight = cache(self._weight)
        zero = (0,) * width

        def grow(depth: int, mask: int) -> int:
            if depth == len(order):
                return self._node(("leaf", *counts.get(mask, zero)))
            return self._node((grow(depth + 1, mask), grow(depth + 1, mask | 1 << depth)))

        self.root = grow(0, 0)

    def _node(self, content: tuple) -> int:
        if content not in self.known:
            self.known[content] = len(self.nodes)
            self.nodes.append(content)
        return self.known[content]

    def _weight(self, node: int) -> tuple[int, ...]:
        content = self.nodes[node]
        if content[0] == "leaf":
            return content[1:]
        return tuple(map(sum, zip(*map(self.weight, content), strict=True)))

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one: only nodes of the two levels get new branches."""

        @cache
        def moved(node: int, depth: int) -> int:
            passed, failed = self.nodes[node]
            if depth < level:
                return self._node((moved(passed, depth + 1), moved(failed, depth + 1)))
            (pp, pf), (fp, ff) = self.nodes[passed], self.nodes[failed]
            return self._node((self._node((pp, fp)), self._node((pf, ff))))

        self.root = moved(self.root, 0)
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, weight that stays, weight that goes) along the path on which all filters pass."""
        node = self.root
        for name in self.order:
            node, failed = self.nodes[node]
            yield name, self.weight(node), self.weight(failed)


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap with the next one, so that all orders of n filters are met once each, the given one first."""
    if n < 2:
        return
    leftwards, inner = True, plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if leftwards else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + leftwards  # the last filter stands before the others after it went left
        leftwards = not leftwards


def part_audit(part: str, counts: Mapping[int, tuple[int, int, int]], names: str = NAMES) -> pd.DataFrame:
    """All orders and steps of one part from its (documents, good, toxic) by mask.

    A filter's failures are what it removes as the first one, those of it alone what it removes as the last one.
    """
    diagram = Diagram(names, counts, 3)
    rows, first, last, total = [], {}, {}, dict.fromkeys(names, 0)
    for level in (None, *plain_changes(len(names))):
        if level is not None:
            diagram.swap(level)
        order = "".join(diagram.order)
        for step, (name, stays, goes) in enumerate(diagram.steps(), 1):
            rows.append((name, part, order, step, stays[0], *goes))
            total[name] += goes[0]
            if step == 1:
                first[name] = goes[0]
            if step == len(names):
                last[name] = goes[0]
    out = [(p, o, s, kept, removed, first[f] - removed, last[f], good, toxic, total[f]) for f, p, o, s, kept, removed, good, toxic in rows]
    return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def audit(counts: DataFrame, names: str = NAMES) -> DataFrame:
    """Every order and step of every part from :func:`mask_counts`, zeros included.

    A part is a group of at most 2 ** len(names) rows. Without documents there are no parts and no rows.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        by_mask = {m: (n, g, t) for m, n, g, t in rows[["mask", "n", "good", "toxic"]].itertuples(index=False, name=None)}
        return part_audit(key[0], by_mask, names)

    return counts.groupBy("part").applyInPandas(run, SCHEMA)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole ``docs``."""
    return audit(mask_counts(failures(docs), labels))
