"""Transcripts of several exons from aligned reads: splice graphs and their heaviest paths.

Reads are counted by Spark into a graph: covered blocks, cut where supported
junctions begin or end, are nodes; junctions and direct neighbourhood are edges.
What one call gets are the graphs of a few loci, whose size is bounded by their
bases and junctions, however many reads there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import align
from .intervals import overlap_join
from .rnaseq import assemble_islands

PLACE = ("sample", "contig", "strand")
LOCI = 64  # neighbouring loci that one call gets


def place_rna_reads(reads: DataFrame, tiles: DataFrame, **options) -> DataFrame:
    """(sample, name, contig, strand, blocks) of ``reads(sample, name, seq)``.

    A read that lies in one piece has one block, by its unique best hit; others
    have two, by the spliced layout of fewest mismatches, then first in order.
    Blocks are 1-based and inclusive; strand is that of the read.
    """
    keyed = reads.select(F.to_json(F.struct("sample", "name")).alias("name"), F.lit(0).alias("mate"), "seq", F.lit("").alias("qual"))
    whole = align.align_reads(keyed, tiles, **options)
    end = F.col("pos") + F.length("seq") - 1
    one = whole.where("mapq > 0").select("name", "contig", "rev", F.array(F.struct(F.col("pos").alias("start"), end.alias("end"))).alias("blocks"))
    spliced = align.spliced_reads(keyed.join(whole.select("name"), "name", "left_anti"), tiles, **{k: v for k, v in options.items() if k in ("k", "max_nm", "max_occ", "tile_len")})
    first = F.min(F.struct("nm", "contig", "start0", "donor", "acceptor", "end0", "rev")).alias("b")
    spliced = spliced.groupBy("name").agg(first).select("name", "b.*")
    blocks = F.array(F.struct((F.col("start0") + 1).alias("start"), F.col("donor").alias("end")), F.struct(F.col("acceptor").alias("start"), F.col("end0").alias("end")))
    both = one.unionByName(spliced.select("name", "contig", "rev", blocks.alias("blocks")))
    key = F.from_json("name", "sample string, name string")
    return both.select(key["sample"].alias("sample"), key["name"].alias("name"), "contig", F.when(F.col("rev"), "-").otherwise("+").alias("strand"), "blocks")


def block_hits(placed: DataFrame) -> DataFrame:
    """(sample, name, contig, strand, start, end): a row for each block of a read."""
    return placed.select("sample", "name", "contig", "strand", F.inline("blocks"))


def supported_junctions(placed: DataFrame, min_support: int = 2) -> DataFrame:
    """(sample, contig, strand, donor, acceptor, support) with enough reads."""
    b = F.col("blocks")
    split = placed.where(F.size(b) == 2).select(*PLACE, b[0]["end"].alias("donor"), b[1]["start"].alias("acceptor"))
    return split.groupBy(*PLACE, "donor", "acceptor").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= min_support)


def graph_nodes(hits: DataFrame, junctions: DataFrame, size: int = 1000) -> DataFrame:
    """(sample, contig, strand, start, end, weight): covered blocks cut at junctions; weight is the number of read bases on them."""
    blocks = assemble_islands(hits, 1, PLACE).select(*PLACE, F.col("start").alias("start0a"), F.col("end").alias("end0a"))
    cuts = junctions.select(*PLACE, F.explode(F.array(F.col("donor") + 1, F.col("acceptor"))).alias("cut")).distinct()
    inside = overlap_join(blocks.withColumn("end0a", F.col("end0a") + 1), cuts.select(*PLACE, "cut", F.col("cut").alias("start0b"), (F.col("cut") + 1).alias("end0b")), PLACE, size)
    inside = inside.groupBy(*PLACE, "start0a").agg(F.collect_set("cut").alias("cuts"))
    begins = F.array_sort(F.array_distinct(F.concat(F.array("start0a"), F.coalesce("cuts", F.array().cast("array<bigint>")))))
    parts = blocks.join(inside, [*PLACE, "start0a"], "left").select(*PLACE, "end0a", begins.alias("b"))
    ends = F.concat(F.transform(F.slice("b", 2, F.size("b")), lambda x: x - 1), F.array("end0a"))
    nodes = parts.select(*PLACE, F.inline(F.arrays_zip(F.col("b").alias("start"), ends.alias("end"))))
    same = hits.groupBy(*PLACE, "start", "end").agg(F.count(F.lit(1)).alias("n"))
    same = same.select(*PLACE, "n", (F.col("start") - 1).alias("start0a"), F.col("end").alias("end0a"))
    both = overlap_join(same, nodes.withColumns({"start0b": F.col("start") - 1, "end0b": F.col("end")}), PLACE, size)
    covered = F.least("end0a", "end0b") - F.greatest("start0a", "start0b")
    return both.groupBy(*PLACE, "start", "end").agg(F.sum(F.col("n") * covered).alias("weight"))


def heaviest_paths(nodes: Sequence[tuple[int, int, int]], junctions: Sequence[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Exons of the heaviest path through each edge of a splice graph, each once, and of each node without an edge.

    ``nodes(start, end, weight)`` and ``junctions(donor, acceptor, support)``. A path
    weighs its nodes and the support of its junctions. Of equal ones the nearer
    predecessor chosen is the one of the smaller start, and so is the successor.
    """
    nodes = sorted(nodes)
    starts, ends = {n[0]: i for i, n in enumerate(nodes)}, {n[1]: i for i, n in enumerate(nodes)}
    edges = [(i, starts[n[1] + 1], 0) for i, n in enumerate(nodes) if n[1] + 1 in starts]
    edges += [(ends[d], starts[a], support) for d, a, support in junctions if d in ends and a in starts]

    def best(order, edges_of):
        """(weight, next node) of the best way from each node to an end of the graph."""
        found = {}
        for i in order:
            ways = [(-(found[j][0] + support), j) for j, support in edges_of[i]]
            weight, j = min(ways, default=(0, None))
            found[i] = (nodes[i][2] - weight, j)
        return found

    before, after = ({i: [] for i in range(len(nodes))} for _ in range(2))
    for i, j, support in edges:
        before[j].append((i, support))
        after[i].append((j, support))
    back, forth = best(range(len(nodes)), before), best(range(len(nodes) - 1, -1, -1), after)

    def way(i, found):
        while i is not None:
            yield i
            i = found[i][1]

    paths = {(*reversed(list(way(i, back))), *way(j, forth)) for i, j, _ in edges}
    paths |= {(i,) for i in range(len(nodes)) if not before[i] and not after[i]}
    out = []
    for path in sorted(paths):
        exons = []
        for start, end, _ in (nodes[i] for i in path):
            if exons and exons[-1][1] + 1 == start:
                exons[-1] = (exons[-1][0], end)
            else:
                exons.append((start, end))
        out.append(exons)
    return out


def assemble_transcripts(placed: DataFrame, min_support: int = 2, size: int = 1000) -> DataFrame:
    """(sample, contig, strand, transcript_id, exon_number, start, end) of each sample's splice graphs.

    ``placed`` is read several times: give a written table. Loci are stretches of
    overlapping blocks and junctions; a transcript is named by its place and exons.
    """
    hits, junctions = block_hits(placed), supported_junctions(placed, min_support)
    nodes = graph_nodes(hits, junctions, size)
    spans = nodes.select(*PLACE, "start", "end").unionByName(junctions.select(*PLACE, F.col("donor").alias("start"), F.col("acceptor").alias("end")))
    loci = assemble_islands(spans, 1, PLACE).select(*PLACE, "island", (F.col("start") - 1).alias("start0b"), F.col("end").alias("end0b"))
    parts = nodes.select(*PLACE, F.lit(True).alias("node"), "start", "end", F.col("weight").alias("w"))
    parts = parts.unionByName(junctions.select(*PLACE, F.lit(False).alias("node"), F.col("donor").alias("start"), F.col("acceptor").alias("end"), F.col("support").alias("w")))
    located = overlap_join(parts.withColumns({"start0a": F.col("start") - 1, "end0a": F.col("start")}), loci, PLACE, size)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        parts = sorted(rows[["island", "node", "start", "end", "w"]].itertuples(index=False, name=None))
        for _, locus in groupby(parts, key=lambda r: r[0]):
            nodes, junctions = [], []
            for _, node, *part in locus:
                (nodes if node else junctions).append(tuple(part))
            for exons in heaviest_paths(nodes, junctions):
                name = ".".join((*key[:3], ",".join(f"{a}-{b}" for a, b in exons)))
                out += [(*key[:3], name, n, a, b) for n, (a, b) in enumerate(exons, 1)]
        return pd.DataFrame(out, columns=[*PLACE, "transcript_id", "exon_number", "start", "end"])

    located = located.select(*PLACE, F.floor(F.col("island") / LOCI).alias("some"), "island", "node", "start", "end", "w")
    return located.groupBy(*PLACE, "some").applyInPandas(run, "sample string, contig string, strand string, transcript_id string, exon_number int, start long, end long")


def merge_assemblies(exons: DataFrame) -> DataFrame:
    """(transcript_id, contig, strand, exon_number, start, end, n_samples): one transcript for equal introns of several samples.

    Its ends are the outermost of them. Transcripts of one exon that overlap or touch become one.
    """
    place = ["contig", "strand"]
    each = exons.groupBy("sample", "transcript_id", *place).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("e"))
    e = F.col("e")
    introns = F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda i: F.struct(F.get(e, i - 1)["end"].alias("donor"), F.get(e, i)["start"].alias("acceptor")))
    ends = F.min("start").alias("start"), F.max("end").alias("end"), F.countDistinct("sample").alias("n_samples")
    spans = each.select("sample", *place, e[0]["start"].alias("start"), F.element_at(e, -1)["end"].alias("end"), F.when(F.size(e) > 1, introns).alias("introns"))
    several = spans.where("introns is not null").groupBy(*place, "introns").agg(*ends)
    alone = spans.where("introns is null")
    # stretches of equal starts are one row here, so a window is bounded by the contig's starts
    same = alone.groupBy(*place, "start").agg(F.max("end").alias("end"))
    along = Window.partitionBy(*place).orderBy("start")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    same = same.withColumn("island", F.sum(F.coalesce(F.col("start") > reach + 1, F.lit(True)).cast("bigint")).over(along)).select(*place, "start", "island")
    single = alone.join(same, [*place, "start"]).groupBy(*place, "island").agg(*ends).drop("island").withColumn("introns", F.array().cast(spans.schema["introns"].dataType))
    every = several.unionByName(single)
    donors, acceptors = F.transform("introns", lambda x: x["donor"]), F.transform("introns", lambda x: x["acceptor"])
    pieces = F.arrays_zip(F.concat(F.array("start"), acceptors).alias("start"), F.concat(donors, F.array("end")).alias("end"))
    texts = F.array_join(F.transform(pieces, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    named = every.select(F.concat_ws(".", *place, texts).alias("transcript_id"), *place, "n_samples", F.posexplode(pieces).alias("i", "p"))
    return named.select("transcript_id", *place, (F.col("i") + 1).alias("exon_number"), F.col("p.start").alias("start"), F.col("p.end").alias("end"), "n_samples")
