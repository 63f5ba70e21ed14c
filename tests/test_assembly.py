"""Splice graphs, merged assemblies and shared fragments."""

import os
import random

import pytest
from pyspark.sql import functions as F

from seqlake.operators import assembly, rnaseq
from seqlake.plans import pipelines
from seqlake.registry.tables import frame
from seqlake.sources.scratch import written

DATA = "/root/testdata/sf0.001"


def all_paths(nodes, junctions):
    """Every maximal path with its weight, by search."""
    nodes = sorted(nodes)
    edges = {(a, b): 0 for a in nodes for b in nodes if b[0] == a[1] + 1}
    edges |= {(a, b): s for d, c, s in junctions for a in nodes if a[1] == d for b in nodes if b[0] == c}
    out = []

    def go(path, weight):
        ahead = [(b, s) for (a, b), s in edges.items() if a == path[-1]]
        if not ahead:
            out.append((weight, path))
        for b, s in ahead:
            go([*path, b], weight + s + b[2])

    for n in nodes:
        if not any(b == n for _, b in edges):
            go([n], n[2])
    return out, edges


@pytest.mark.parametrize("seed", range(30))
def test_heaviest_paths_against_all_paths(seed):
    r = random.Random(seed)
    at, nodes = 1, []
    for _ in range(r.randint(1, 9)):
        n = r.randint(1, 5)
        nodes.append((at, at + n - 1, r.randint(1, 10**6)))
        at += n + r.choice([0, 0, 7])
    junctions = [(a[1], b[0], r.randint(2, 9)) for a in nodes for b in nodes if b[0] > a[1] + 1 and r.random() < 0.35]
    paths, edges = all_paths(nodes, junctions)
    want = set()
    for a, b in edges:
        through = [(w, p) for w, p in paths if any(x == a and y == b for x, y in zip(p, p[1:], strict=False))]
        want.add(tuple(max(through, key=lambda x: x[0])[1]))
    want |= {tuple(p) for _, p in paths if len(p) == 1}
    got = assembly.heaviest_paths(nodes, junctions)
    assert {tuple(b for e in p for b in range(e[0], e[1] + 1)) for p in got} == {tuple(b for s, e, _ in p for b in range(s, e + 1)) for p in want}
    assert all(a[1] + 1 < b[0] for p in got for a, b in zip(p, p[1:], strict=False))


def test_reads_of_two_isoforms_become_two_transcripts(spark):
    place = ("s", "c", "+")
    blocks = [[(1, 30)]] * 3 + [[(21, 40), (101, 120)]] * 3 + [[(101, 140)]] * 2 + [[(121, 140), (201, 220)]] * 2 + [[(21, 40), (201, 220)]] * 2 + [[(30, 40), (90, 99)]] + [[(500, 540)]]
    rows = [("s", f"r{i}", "c", "+", b) for i, b in enumerate(blocks)]
    placed = spark.createDataFrame(rows, "sample string, name string, contig string, strand string, blocks array<struct<start: long, end: long>>")
    got = written(assembly.assemble_transcripts(written(placed, "placed")), "got")
    names = {r["transcript_id"] for r in got.collect()}
    assert {"s.c.+.1-40,101-140,201-220", "s.c.+.1-40,201-220", "s.c.+.500-540"} <= names and place == ("s", "c", "+")
    assert not any("41" in n for n in names)  # one read does not support a junction
    other = got.withColumns({"sample": F.lit("t"), "start": F.when(F.col("start") == 1, 5).otherwise(F.col("start"))})
    merged = assembly.merge_assemblies(got.unionByName(other))
    both = {r["transcript_id"]: r["n_samples"] for r in merged.collect()}
    assert both["c.+.1-40,101-140,201-220"] == 2 and both["c.+.500-540"] == 2


def test_empty_reads_have_no_transcripts(spark):
    tiles = spark.createDataFrame([("c", 0, 0, "ACGT" * 8)], "contig string, tile long, start0 long, seq string")
    reads = spark.createDataFrame([], "sample string, name string, seq string")
    placed = assembly.place_rna_reads(reads, tiles)
    assert assembly.merge_assemblies(assembly.assemble_transcripts(placed)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
def test_the_study_finds_whole_and_partial_transcripts(spark):
    study = pipelines.rnaseq_study(frame(spark, DATA, "rna_reads"), frame(spark, DATA, "contig_tiles"), frame(spark, DATA, "rna_ref_exons"), {"1": "T1", "2": "T1", "3": "T2", "4": "T2"})
    rows = study.collect()
    codes = {r["class_code"] for r in rows}
    assert {"=", "c", "u"} <= codes and max(r["n_exons"] for r in rows) >= 3 and any(r["p"] is not None for r in rows)


def test_shared_fragments_go_where_unique_ones_are(spark):
    exons = [("s", t, "c", "+", a, b) for t, spans in {"long": [(1, 100), (201, 300)], "short": [(1, 100)]}.items() for a, b in spans]
    exons = spark.createDataFrame(exons, "sample string, transcript_id string, contig string, strand string, start long, end long")
    hits = [("s", f"u{i}", "c", "+", 210, 240) for i in range(40)] + [("s", f"b{i}", "c", "+", 10, 40) for i in range(50)]
    hits = spark.createDataFrame(hits, "sample string, name string, contig string, strand string, start long, end long")
    got = {r["transcript_id"]: r for r in rnaseq.shared_abundance(hits, exons, rounds=8).collect()}
    assert got["long"]["n_frag"] == 90 and got["long"]["n_unique"] == 40 and got["short"]["n_frag"] == 50 and got["short"]["n_unique"] == 0
    assert abs(got["long"]["micro_frag"] - 80e6) < 8e6 and abs(sum(r["micro_frag"] for r in got.values()) - 90e6) < 100


def test_rounds_of_shared_abundance_carry_no_lists_of_transcripts(spark):
    exons = spark.createDataFrame([("s", "a", "c", "+", 1, 100), ("s", "b", "c", "+", 51, 150)], "sample string, transcript_id string, contig string, strand string, start long, end long")
    hits = spark.createDataFrame([("s", "h", "c", "+", 60, 90), ("s", "i", "c", "+", 1, 20)], "sample string, name string, contig string, strand string, start long, end long")
    got = rnaseq.shared_abundance(hits, exons)
    assert "transcripts" not in got._jdf.queryExecution().analyzed().toString()
    assert sorted((r["transcript_id"], r["n_frag"], r["n_unique"]) for r in got.collect()) == [("a", 2, 1), ("b", 1, 0)]
