"""Pileups, a threshold caller, and call sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import natural_key, phred
from ..sources.text import drop_header_lines

BASES = ("A", "C", "G", "T")
SALTS = 16  # tasks that count the positions of one cell


def min_quality_filter(alignments: DataFrame, min_mapq: int = 0, min_mean_qual: int = 0) -> DataFrame:
    """Alignments above a mapping quality whose mean base quality reaches a bound."""
    total = F.aggregate(F.split("qual", ""), F.lit(0), lambda acc, c: acc + F.when(c == "", 0).otherwise(phred(c)))
    return alignments.where((F.col("mapq") > min_mapq) & (total >= min_mean_qual * F.length("qual")))


def aligned_bases(alignments: DataFrame, min_phred: int = 25, stretch: int = 10_000) -> DataFrame:
    """(contig, pos, base): the bases of well-placed reads of enough quality.

    Reads of one stretch of a contig come to one task, so that partial counts of a position are few wherever
    its reads come from; Spark deals those of a deep stretch to several.
    """
    rows = alignments.where("mapq > 0").select("contig", "pos", "seq", "qual", F.floor(F.col("pos") / stretch).alias("_stretch"))
    rows = rows.hint("rebalance", F.col("contig"), F.col("_stretch"))
    rows = rows.select("contig", "pos", "seq", "qual", F.explode(F.sequence(F.lit(0), F.length("seq") - 1)).alias("i"))
    rows = rows.where(F.expr(f"ascii(substr(qual, i + 1, 1)) - 33 >= {min_phred}"))
    return rows.select("contig", (F.col("pos") + F.col("i")).alias("pos"), F.expr("substr(seq, i + 1, 1)").alias("base"))


def pileup(alignments: DataFrame, min_phred: int = 25) -> DataFrame:
    """(contig, pos, base, n)."""
    return aligned_bases(alignments, min_phred).groupBy("contig", "pos", "base").agg(F.count(F.lit(1)).alias("n"))


def call_snps(alignments: DataFrame, tiles: DataFrame, min_phred: int = 25, min_depth: int = 4, tile_len: int = 32) -> DataFrame:
    """(contig, pos, ref, alt, qual, depth, alt_n, gt) by thresholds on base counts.

    The counts of a position are one aggregation with partial sums; the
    reference base joins the counts, not the reads. Four fifths of the depth
    make 1/1, one fifth 0/1; qual is ten times the alt bases.
    """
    depths = aligned_bases(alignments, min_phred).groupBy("contig", "pos").agg(
        F.count(F.lit(1)).alias("depth"), *(F.count_if(F.col("base") == b).alias(b) for b in BASES)
    )
    zero = F.col("pos") - 1
    bases = tiles.select("contig", F.col("tile").alias("_t"), F.col("seq").alias("_b"))
    counts = depths.where(F.col("depth") >= min_depth).withColumn("_t", F.floor(zero / tile_len)).join(bases, ["contig", "_t"])
    counts = counts.withColumn("ref", F.substr("_b", (zero % tile_len).cast("int") + 1, F.lit(1))).where("ref <> ''")
    alts = counts.select(
        "contig", "pos", "ref", "depth", F.explode(F.array(*(F.struct(F.lit(b).alias("alt"), F.col(b).alias("alt_n")) for b in BASES))).alias("x")
    ).select("contig", "pos", "ref", "depth", "x.*")
    gt = F.when(F.col("alt_n") * 5 >= F.col("depth") * 4, "1/1").when(F.col("alt_n") * 5 >= F.col("depth"), "0/1")
    called = alts.where(F.col("alt") != F.col("ref")).withColumn("gt", gt).where("gt is not null")
    return called.select("contig", "pos", "ref", "alt", (F.col("alt_n") * 10).alias("qual"), "depth", "alt_n", "gt")


def genome_bins(df: DataFrame, size: int = 1_000_000, partitions: int | None = None) -> DataFrame:
    """``df(contig, pos, ...)`` with its bin, dealt by ranges of (contig, bin)."""
    binned = df.withColumn("bin", F.floor((F.col("pos") - 1) / size).cast("bigint"))
    return binned.repartitionByRange(partitions, "contig", "bin") if partitions else binned.repartitionByRange("contig", "bin")


def load_bins(df: DataFrame, rows_per_bin: int, cell: int = 10_000) -> DataFrame:
    """(contig, bin, low, high): stretches of each contig with about ``rows_per_bin`` rows of ``df(contig, pos, ...)``.

    A position belongs to the bin that its rank among the contig's rows falls in, so a deep locus is cut
    more finely, and no bin has ``rows_per_bin`` rows more than its last position has. Positions are not cut: all
    rows of one are in one bin. Stretches follow each other from 1 to the last one's open end; their numbers
    ascend, and leave out those that one position runs over. Ranks are sums within cells of ``cell`` bases and
    of cells: no window has more rows than a cell has bases or a contig has cells.
    """
    at = df.where("contig is not null and pos is not null").select("contig", F.greatest("pos", F.lit(1)).cast("bigint").alias("pos"))
    # dealt first: a task that counts what a file happens to hold would keep every position of it in memory; those of a deep cell stay apart by where they were read
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = at.withColumn("_cell", F.floor(F.col("pos") / cell)).repartition(parts, "contig", "_cell", F.spark_partition_id() % SALTS)
    sites = dealt.groupBy("contig", "_cell", "pos").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("contig").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = sites.groupBy("contig", "_cell").agg(F.sum("n").alias("n"), F.max("pos").alias("end"))
    cells = cells.select(
        "contig", "_cell", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"), F.coalesce(F.max("end").over(along), F.lit(0)).alias("earlier"),
        F.max("end").over(Window.partitionBy("contig")).alias("final"),
    )
    inside = Window.partitionBy("contig", "_cell").orderBy("pos")
    rank = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = sites.withColumns({"rank": rank, "last": F.lag("pos").over(inside)}).join(cells, ["contig", "_cell"])
    ranked = ranked.withColumn("bin", F.floor((F.col("before") + F.col("rank")) / rows_per_bin).cast("bigint"))
    low, high = F.min(F.coalesce("last", "earlier")) + 1, F.max(F.when(F.col("pos") == F.col("final"), (1 << 62) - 1).otherwise(F.col("pos")))
    return ranked.groupBy("contig", "bin").agg(low.alias("low"), high.alias("high"))


def in_load_bins(df: DataFrame, bins: DataFrame, pad: int = 0, cell: int = 256) -> DataFrame:
    """``df(contig, pos, ...)`` once for each of :func:`load_bins` within ``pad`` of a row: plus _bin, _low and _high.

    Rows and bins meet in cells of ``cell`` bases; a pair counts in that of its later start. A contig's last bin
    has no end: it lies in the cell that it starts in, and so do all rows beyond.
    """
    tops = bins.groupBy("contig").agg(F.floor(F.max("low") / cell).alias("_top"))  # a row a contig
    top = F.col("_top")
    ends = F.sequence(F.floor(F.col("low") / cell), F.least(F.floor(F.col("high") / cell), top))
    spread = bins.join(tops, "contig").select("contig", F.col("bin").alias("_bin"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.explode(ends).alias("_cell"))
    first, last = (F.greatest(F.col("pos") + d, F.lit(1)) for d in (-pad, pad))
    rows = df.join(tops, "contig").withColumn("_cell", F.explode(F.sequence(F.least(F.floor(first / cell), top), F.least(F.floor(last / cell), top))))
    pairs = rows.join(spread, ["contig", "_cell"]).where((first <= F.col("_high")) & (last >= F.col("_low")))
    own = pairs.where(F.least(F.floor(F.greatest(first, F.col("_low")) / cell), top) == F.col("_cell"))
    return own.select(*df.columns, "_bin", "_low", "_high")


def union_shards(*shards: DataFrame) -> DataFrame:
    """All rows of all shards, duplicates too."""
    out = shards[0]
    for shard in shards[1:]:
        out = out.unionByName(shard)
    return out


def contig_ranks(contigs: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(contig, len, rank): the header's order, by the number in the name unless names are given."""
    if names is not None:
        order = contigs.sparkSession.createDataFrame(list(zip(names, range(len(names)), strict=True)), "contig string, rank int")
        return contigs.join(order, "contig", "left").select("contig", "len", F.coalesce("rank", F.lit(2**31 - 1)).alias("rank"))
    by = Window.orderBy(*natural_key(F.col("contig")))  # contigs are few
    return contigs.select("contig", "len", F.row_number().over(by).alias("rank"))


def vcf_merge(shards: DataFrame, ranks: DataFrame) -> DataFrame:
    """(rank, contig, pos, ref, alt, qual, shard), and gt where shards have it: one row a variant, the highest qual, then the lowest shard.

    Contigs that the header lacks have the last rank.
    """
    more = ["gt"] if "gt" in shards.columns else []
    best = F.max_by(F.struct("qual", "shard", *more), F.struct("qual", -F.col("shard"), *more)).alias("b")
    merged = shards.groupBy("contig", "pos", "ref", "alt").agg(best).select("contig", "pos", "ref", "alt", "b.*")
    # the header names every contig of the genome: small by nature, joined as Spark sees fit
    return merged.join(ranks.select("contig", "rank"), "contig", "left").select(
        F.coalesce("rank", F.lit(2**31 - 1)).alias("rank"), "contig", "pos", "ref", "alt", "qual", "shard", *more
    )


def in_order(variants: DataFrame) -> DataFrame:
    return variants.orderBy("rank", "pos", "ref", "alt")


def vcf_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(side, line, n): lines (value) that one side has more often; empty if equal. Headers are ignored."""
    a, b = drop_header_lines(left).select("value"), drop_header_lines(right).select("value")
    sign = a.select("value", F.lit(1).alias("d")).unionByName(b.select("value", F.lit(-1).alias("d"))).groupBy("value").agg(F.sum("d").alias("d")).where("d <> 0")
    return sign.select(F.when(F.col("d") > 0, "left").otherwise("right").alias("side"), F.col("value").alias("line"), F.abs("d").alias("n"))


def vcf_values(variants: DataFrame) -> DataFrame:
    """Lines without headers, for comparison."""
    return variants.select(F.concat_ws("\t", "contig", F.col("pos").cast("string"), "ref", "alt", F.col("qual").cast("string")).alias("value"))
