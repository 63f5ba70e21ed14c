"""Truth, invariance, formats and plans of the sequencing operators."""

import datetime
import gzip
import io
import os
import random
import time
from itertools import combinations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from seqlake.functions import scalars
from seqlake.operators import align, apply, intervals, jobs, recal, rnaseq, variants
from seqlake.plans import pipelines
from seqlake.registry.tables import TABLES, frame, sql
from seqlake.sources import fastq, text
from seqlake.sources.scratch import written
from seqlake.streaming import jobs as stream

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_are_at_their_true_place_and_planted_snps_are_called(spark):
    reads, tiles = frame(spark, DATA, "reads"), frame(spark, DATA, "contig_tiles")
    aligned = align.align_reads(reads, tiles).cache()
    truth = frame(spark, DATA, "placed_reads").select("name", "mate", "true_contig", "true_pos")
    placed = aligned.join(truth, ["name", "mate"]).where("contig = true_contig and pos = true_pos").count()
    assert placed >= 0.999 * truth.count()
    called = variants.call_snps(aligned, tiles).select("contig", "pos")
    known = frame(spark, DATA, "known_sites")
    assert called.count() > 0 and called.exceptAll(known).count() == 0
    aligned.unpersist()


@pytest.mark.parametrize("n", [100, 150])
def test_long_reads_align_and_count_every_mismatch(spark, n):
    r = random.Random(n)
    genome = "".join(r.choice("ACGT") for _ in range(640))
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in range(0, 640, 32)], "contig string, tile long, start0 long, seq string")
    swap = str.maketrans("ACGT", "CATG")
    rows = []
    for start in range(0, 640 - n + 1, 13):
        s = genome[start : start + n]
        rows.append((f"r{start}", 1, s[:-9] + s[-9:-6].translate(swap) + s[-6:], "I" * n))
    bad = genome[:70] + genome[70:80].translate(swap) + genome[80:n]  # ten mismatches beyond the first 60 bases
    reads = spark.createDataFrame([*rows, ("bad", 1, bad, "I" * n)], "name string, mate int, seq string, qual string")
    got = {x["name"]: (x["pos"], x["nm"]) for x in align.align_reads(reads, tiles).collect()}
    assert got == {f"r{s}": (s + 1, 3) for s in range(0, 640 - n + 1, 13)}
    spliced = spark.createDataFrame([("j", genome[40 : 40 + n // 2] + genome[300 : 300 + n // 2])], "name string, seq string")
    found = align.splice_junctions(spliced, tiles).collect()
    assert len(found) == 1 and found[0]["acceptor"] - found[0]["donor"] == 300 - (40 + n // 2) + 1


def brute_places(genome, reads, max_nm):
    import numpy as np

    g = np.frombuffer(genome.encode(), np.uint8)
    out = {}
    for name, seq in reads:
        for rev, s in ((False, seq), (True, seq[::-1].translate(str.maketrans("ACGT", "TGCA")))):
            q = np.frombuffer(s.encode(), np.uint8)
            for at, w in enumerate(np.lib.stride_tricks.sliding_window_view(g, len(q))):
                if (nm := int((w != q).sum())) <= max_nm:
                    out.setdefault(name, []).append((nm, at + 1, rev))
    return {n: min(p) for n, p in out.items()}


@pytest.mark.parametrize("window", [1, 3])
def test_no_place_is_lost_wherever_the_mismatches_are(spark, window):
    r = random.Random(window)
    genome = "".join(r.choice("ACGT") for _ in range(1500))
    genome = genome[:900] + genome[100:160] + genome[900:] + "A" * 60  # a repeat and a frequent k-mer
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in range(0, len(genome), 32)], "contig string, tile long, start0 long, seq string")
    reads = []
    for n in (40, 41, 75, 79, 80, 81, 150, 250):
        for j in range(12):
            at = r.randrange(len(genome) - n + 1)
            s = list(genome[at : at + n])
            for i in (r.sample(range(n), 4) if j % 3 else [13, 26]):
                s[i] = r.choice("ACGTN".replace(s[i], ""))
            s = "".join(s)
            reads.append((f"r{n}.{j}", s if j % 2 else s[::-1].translate(str.maketrans("ACGT", "TGCA"))))
    df = spark.createDataFrame([(n, 1, s, "I" * len(s)) for n, s in reads], "name string, mate int, seq string, qual string")
    want = brute_places(genome, reads, 4)
    assert len(want) == len(reads)
    if window == 1:
        got = align.align_everywhere(df, tiles)
    else:
        long = df.where("length(seq) >= 75")
        got = align.align_reads(long, tiles, k=11, window=window, everywhere=True)  # parts hold 13 bases at least
        want = {n: p for n, p in want.items() if int(n[1:].split(".")[0]) >= 75}
    assert {x["name"]: (x["nm"], x["pos"], x["rev"]) for x in got.collect()} == want


def test_short_parts_meet_few_places_by_chance(spark):
    r = random.Random(5)
    genome = "".join(r.choice("ACGT") for _ in range(60_000))
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in range(0, len(genome), 32)], "contig string, tile long, start0 long, seq string")
    reads = spark.createDataFrame([(f"r{i}", 1, genome[i * 500 : i * 500 + 40], "I" * 40) for i in range(100)], "name string, mate int, seq string, qual string")
    met = align.pair_seeds(reads).join(align.paired_index(tiles), "kmer").count()
    assert 1500 <= met <= 100 * (15 + 30)  # every pair at the true place, and some 0.1 to 0.2 a pair by chance
    assert align.align_everywhere(reads, tiles).where("nm = 0").count() == 100


def test_triples_of_parts_meet_fewer_places_by_chance(spark):
    triples = align.covering_triples(8)
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4)) and len(triples) == 20
    r = random.Random(6)
    genome = "".join(r.choice("ACGT") for _ in range(60_000))
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in range(0, len(genome), 32)], "contig string, tile long, start0 long, seq string")
    swap = str.maketrans("ACGT", "CGTA")
    texts = [genome[i * 500 : i * 500 + 40] for i in range(100)]
    worn = [s[:4] + s[4:6].translate(swap) + s[6:29] + s[29:31].translate(swap) + s[31:] for s in texts]  # four parts of five bases are wrong
    reads = spark.createDataFrame([(f"r{i}", 1, s, "I" * 40) for i, s in enumerate(worn)], "name string, mate int, seq string, qual string")
    met = align.set_seeds(reads, triples, 5, 8).join(align.set_index(tiles, sorted({align.shape_of(t) for t in triples}), 5), "kmer").count()
    assert 100 <= met <= 100 * 5  # 40 seeds a read, with a place by chance for one in 18,000 of them; pairs meet 11 a read
    stages = []
    whole, staged = (align.align_everywhere(reads, tiles, stage=s) for s in (None, lambda df, label: stages.append(label) or written(df, label)))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, staged.collect())) and whole.where("nm = 4").count() == 100
    assert len(stages) == 1 + 8  # long reads, and the shapes of the triples


def shuffle_files(spark, at_most):
    """Shuffle files on disk, after some waiting for them to be ``at_most``: Spark removes them in the background."""
    for _ in range(100):
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
        if files.count("shuffle_") <= at_most:
            break
        time.sleep(0.1)
    return files.count("shuffle_")


def test_batches_of_reads_align_alike_and_leave_no_shuffles(spark):
    reads, tiles = (written(frame(spark, DATA, t), t) for t in ("reads", "contig_tiles"))
    before = shuffle_files(spark, 0)
    batches = align.align_in_batches(reads, tiles, batch=reads.count() // 3 + 1)
    assert shuffle_files(spark, before) <= before
    assert batches.exceptAll(align.align_reads(reads, tiles)).count() == 0 and batches.count() == align.align_reads(reads, tiles).count()


def test_pieces_of_long_reads_on_blocks(spark):
    r = random.Random(9)
    genome = "".join(r.choice("ACGT") for _ in range(1200))
    starts = [i for i in range(0, 1200, 32) if i not in (608, 640)]  # two tiles are missing, and the last one is short
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in starts], "contig string, tile long, start0 long, seq string")
    cut = [(n, at) for n in (40, 61, 200, 330) for at in (0, 1, 130, 200, 250, 262, 500, 580, 700, 1200 - n) if at + n <= 1200]
    reads = spark.createDataFrame([(f"{at}+{n}", 1, genome[at : at + n], "I" * n) for n, at in cut], "name string, mate int, seq string, qual string")
    want = {f"{at}+{n}": at + 1 for n, at in cut if at + n <= 608 or at >= 672}
    assert {x["name"]: x["pos"] for x in align.align_reads(reads, tiles).where("nm = 0 and not rev").collect()} == want


def test_calls_of_shards_meet_tiles_not_bases(spark):
    assert "ref_bases" not in TABLES["vcf_shards"][0] and frame(spark, DATA, "vcf_shards").count() > 0


def test_a_kept_index_is_read_without_a_shuffle(spark, tmp_path):
    tiles = frame(spark, DATA, "contig_tiles")
    frame(spark, DATA, "reads").write.parquet(str(tmp_path / "reads"))
    reads = spark.read.parquet(str(tmp_path / "reads"))
    spark.sql("DROP TABLE IF EXISTS kept_kmers")
    align.save_index(tiles, "kept_kmers", str(tmp_path / "kept"), 4, window=5)
    index = spark.table("kept_kmers")
    assert 0.2 < index.count() / align.minimizers(tiles).count() < 0.6
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = align.seeds(reads, offsets=(0,)).join(index, "kmer")
        text = plan(found)
        assert text.count("Exchange") == 1 and "Exchange" not in text[text.index("kept_kmers") - 200 :], text  # that of the seeds
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(AnalysisException):
        align.save_index(tiles, "kept_kmers", str(tmp_path / "other"), 4)
    spark.sql("DROP TABLE kept_kmers")


def test_positions_are_dealt_before_they_are_counted(spark):
    df = spark.range(8000, numPartitions=5).select(F.lit("c").alias("contig"), (F.col("id") % 40).alias("pos"))
    bins = variants.load_bins(df, 400)
    text = plan(bins)
    assert text.rindex("HashAggregate") < text.rindex("Exchange"), text  # the deepest step is the exchange
    sizes = variants.in_load_bins(df, bins).groupBy("_bin").count().collect()
    assert sum(r["count"] for r in sizes) == 8000 and max(r["count"] for r in sizes) <= 600


def test_no_job_starts_while_plans_are_built(spark):
    reads, tiles, contigs, sites, spliced = (frame(spark, DATA, t) for t in ("reads", "contig_tiles", "contig_lens", "known_sites", "spliced_reads"))
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        aligned = align.align_reads(reads, tiles)
        variants.call_snps(aligned, tiles)
        table = recal.count_covariates(aligned, tiles, sites)
        recal.recalibrate(aligned, table)
        pipelines.snp_pipeline(reads, tiles, contigs)
        pipelines.recalibrated_calls(aligned, tiles, contigs)
        align.splice_junctions(spliced, tiles)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_chains_are_written_table_by_table(spark):
    """Their rows are compared with SQL in test_queries."""
    reads, tiles, contigs = (frame(spark, DATA, t) for t in ("reads", "contig_tiles", "contig_lens"))
    labels = []

    def stage(df, label):
        labels.append(label)
        return df.limit(0)

    pipelines.recalibrated_calls(align.align_reads(reads, tiles), tiles, contigs, 200, stage)
    spliced, hits, exons = (frame(spark, DATA, t) for t in ("spliced_reads", "rna_hits", "ref_exons"))
    pipelines.rnaseq_from_reads(spliced, tiles, hits, exons, {"1": "T1", "2": "T2"}, stage)
    assert labels == ["calls", "covariates", "covariates", "covariates", "junctions", "loci", "levels", "classes", "spanned"]


def test_known_sites_meet_tiles_and_not_bases(spark):
    tile = "ACGTTGCAACGTACGTTTGACCAGTACGATCA"
    tiles = spark.createDataFrame([("c", 0, 0, tile), ("c", 1, 32, tile[::-1])], "contig string, tile bigint, start0 bigint, seq string")
    whole = tile + tile[::-1]
    hits = spark.createDataFrame([("c", p, p % 2 == 0, whole[p - 1 : p + 39], "I" * 40, 60) for p in (1, 2, 9, 25)], "contig string, pos bigint, rev boolean, seq string, qual string, mapq int")
    known = [("c", 1), ("c", 32), ("c", 33), ("c", 33), ("c", None), (None, 5), ("d", 10)]
    mask = spark.createDataFrame(known, "contig string, pos bigint")
    found = recal.count_covariates(hits, tiles, mask)
    assert "LeftAnti" not in plan(found)
    off = sum((h.contig, h.pos + i) not in known for h in hits.collect() for i in range(40))
    assert [tuple(r) for r in found.agg(F.sum("n_obs"), F.sum("n_mismatch")).collect()] == [(off, 0)]


def test_covariates_of_long_reads_by_pieces(spark):
    r = random.Random(3)
    genome = "".join(r.choice("ACGTN") for _ in range(900))
    tiles = spark.createDataFrame([("c", i // 32, i, genome[i : i + 32]) for i in range(0, 900, 32)], "contig string, tile long, start0 long, seq string")
    hits = []
    for n in (1, 40, 61, 300):
        for p in (1, 200, 255, 301, 880):
            seq = "".join(b if r.random() < 0.8 else r.choice("ACGTN") for b in genome[p - 1 : p - 1 + n].ljust(n, "A"))
            hits.append(("c", p, r.random() < 0.5, seq, "".join(chr(r.randint(53, 70)) for _ in range(n)), 60))
    known = {r.randrange(1, 901) for _ in range(150)}
    want = {}
    for _, p, rev, seq, qual, _ in hits:
        read = seq[::-1].translate(str.maketrans("ACGT", "TGCA")) if rev else seq
        for i, b in enumerate(seq):
            if p + i <= 900 and p + i not in known:
                cycle = len(seq) - i if rev else i + 1
                key = (ord(qual[i]) - 33, cycle, ("N" + read)[cycle - 1 : cycle + 1])
                n, wrong = want.get(key, (0, 0))
                want[key] = (n + 1, wrong + (b != genome[p + i - 1]))
    rows = spark.createDataFrame(hits, "contig string, pos long, rev boolean, seq string, qual string, mapq int")
    found = recal.count_covariates(rows, tiles, spark.createDataFrame([("c", p) for p in known], "contig string, pos long"))
    assert {tuple(x)[:3]: tuple(x)[3:] for x in found.collect()} == want
    text = plan(found)  # what travels to the tiles is a piece of 60 bases and its qualities, not the read once for each tile
    assert "sequence(0, (n#" in text, text


def test_reads_of_a_stretch_are_counted_together(spark):
    hits = spark.createDataFrame([("c", p, "ACGT" * 10, "I" * 40, 60) for p in (1, 9_990, 9_999, 10_000, 25_000)] * 3, "contig string, pos bigint, seq string, qual string, mapq int")
    assert "REBALANCE" in plan(variants.pileup(hits.repartition(4)))
    assert variants.pileup(hits.repartition(4)).agg(F.sum("n")).first()[0] == 5 * 3 * 40


def test_recalibration_looks_up_or_joins(spark):
    reads = [("a", 1, "c", 1, False, "ACGTN", "IIII5"), ("b", 1, "c", 1, True, "ACGTN", "I5III"), ("e", 1, "c", 1, False, "", ""), ("x", 1, "c", 1, True, "AC*GT", "!~III")]
    alignments = spark.createDataFrame(reads, "name string, mate int, contig string, pos long, rev boolean, seq string, qual string")
    table = spark.createDataFrame([(40, 1, "NA", 98, 9), (40, 2, "AC", 998, 0), (20, 5, "TN", 8, 4), (40, 1, "NN", 0, 0), (40, 3, "AC", 98, 9), (40, 1, "NA", 98, 9), (200, 1, "NA", 1, 1)], "reported_q int, cycle int, context string, n_obs long, n_mismatch long")
    table = recal.merge_covariates(table)
    by_array, by_join = (sorted(map(tuple, recal.recalibrate(alignments, table, m).collect())) for m in (300, 0))
    assert by_array == by_join and by_array[0][6] != "IIII5"
    text = plan(recal.recalibrate(alignments.where("length(seq) < 9"), table))
    assert "Subquery" in text
    assert sorted(map(tuple, recal.recalibrate(alignments, table.limit(0)).collect())) == sorted(reads)


def test_alignment_does_not_depend_on_partitions(spark):
    reads, tiles = frame(spark, DATA, "reads").where("name < 'r0000200'"), frame(spark, DATA, "contig_tiles")
    a, b = (sorted(map(tuple, align.align_reads(reads.repartition(n), tiles).collect())) for n in (1, 7))
    assert a == b and a


def test_unknown_bases_match_nothing_but_themselves(spark):
    df = spark.createDataFrame([("ACGTN" * 8, "ACGTN" * 8), ("ACGTA" * 8, "ACGTN" * 8), ("", ""), ("A" * 40, "T" * 40)], "a string, b string")
    got = [r[0] for r in df.select(scalars.mismatches(scalars.packed(F.col("a"), 60), scalars.packed(F.col("b"), 60))).collect()]
    assert got == [0, 8, 0, 40]


def test_intersection_does_not_depend_on_bin_size(spark):
    a, b = frame(spark, DATA, "feature_bed"), frame(spark, DATA, "exons")
    one, other = (intervals.interval_intersect(a, b, size=n) for n in (70, 5000))
    assert one.count() == other.count() > 0
    assert one.exceptAll(other).count() == 0


def test_bins_of_equal_load_split_a_deep_locus(spark):
    r = random.Random(8)
    spots = [("c", p) for p in range(1, 20_001, 20)] + [("c", r.randrange(5000, 5200)) for _ in range(3000)] + [("d", 7)] * 40
    df = spark.createDataFrame(spots, "contig string, pos long")
    bins = variants.load_bins(df, 100).collect()
    sizes = [sum(b["low"] <= p <= b["high"] for c, p in spots if c == b["contig"]) for b in bins]
    own = sorted(n for n, b in zip(sizes, bins, strict=True) if b["contig"] == "c")
    assert sum(sizes) == len(spots) and own[-1] <= 2 * own[len(own) // 2]
    seen = apply.apply_per_load(df, lambda rows: rows.assign(n=len(rows)), "contig string, pos long, n long", 100, 30).collect()
    assert sorted((x["contig"], x["pos"]) for x in seen) == sorted(spots)

    def neighbours(rows):
        rows = rows.sort_values("pos")
        at = rows["pos"].to_numpy()
        return rows.assign(near=at.searchsorted(at + 30, "right") - at.searchsorted(at - 30, "left"))[["contig", "pos", "near"]]

    near = apply.apply_per_load(df, neighbours, "contig string, pos long, near long", 100, 30).collect()
    want = sorted((c, p, sum(d == c and abs(q - p) <= 30 for d, q in spots)) for c, p in spots if p % 7 == 0)
    assert sorted(tuple(x) for x in near if x["pos"] % 7 == 0) == want


def test_bins_of_equal_load_have_no_most_number(spark):
    df = spark.range(1, 40_001).select(F.lit("c").alias("contig"), (F.col("id") * 3).alias("pos"))
    bins = variants.load_bins(df, 10)
    assert bins.count() == 4000
    sizes = variants.in_load_bins(df, bins).groupBy("_bin").count()
    assert [tuple(r) for r in sizes.agg(F.count("*"), F.min("count"), F.max("count")).collect()] == [(4000, 10, 10)]
    far = spark.createDataFrame([("c", 0), ("c", 10**12), ("c", 31)], "contig string, pos long")  # before, beyond, within 1 of the second
    assert sorted((r["pos"], r["_bin"]) for r in variants.in_load_bins(far, bins, 1).collect()) == [(0, 0), (31, 0), (31, 1), (10**12, 3999)]


def test_reads_cut_from_tiles_are_those_of_whole_contigs(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("part", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = frame(spark, DATA, "placed_reads")
    want = con.sql(sql("SELECT name, o, mate, seq, qual, true_contig, true_pos FROM placed_reads")).fetchall()
    assert sorted(map(tuple, got.select("name", "o", "mate", "seq", "qual", "true_contig", "true_pos").collect())) == sorted(want)
    assert "sample_contigs" not in TABLES["placed_pairs"][0] + TABLES["placed_reads"][0]  # no row holds a contig


def test_nested_bins_give_each_pair_once_with_few_rows(spark):
    r = random.Random(6)
    lengths = [1, 2, 100, 255, 256, 257, 2048, 5000, 500_000, 3_000_000, 10**9]
    rows = [("c" if i % 5 else "d", i, s := r.choice([r.randrange(4000), r.randrange(10**6), 256 * r.randrange(40)]), s + r.choice(lengths)) for i in range(400)]
    rows += [("c", 900, 7, 7)]  # empty: overlaps nothing
    a = spark.createDataFrame(rows[:200] + rows[400:], "contig string, a int, start0a long, end0a long")
    b = spark.createDataFrame(rows[200:], "contig string, b int, start0b long, end0b long")
    joined = intervals.nested_overlap_join(a, b, ["contig"])
    got = sorted((x["a"], x["b"]) for x in joined.collect())
    want = sorted((i, j) for c, i, s, e in rows[:200] for d, j, t, f in rows[200:] if c == d and max(s, t) < min(e, f))
    assert got == want and "NestedLoop" not in plan(joined)
    introns = spark.range(50).select(F.lit("c").alias("contig"), (F.col("id") * 1000).alias("start0b"), (F.col("id") * 1000 + 500_000).alias("end0b"))
    spread = intervals.nested_overlap_join(introns.toDF("contig", "start0a", "end0a"), introns, ["contig"])
    assert spread.count() == sum(abs(i - j) * 1000 < 500_000 for i in range(50) for j in range(50))


def test_fastq_lines_are_numbered_however_files_are_split(spark, tmp_path):
    reads = frame(spark, DATA, "reads").where("mate = 1").select("name", F.lit("x y").alias("description"), "seq", "qual")
    text.fastq_lines(reads).coalesce(1).write.text(str(tmp_path / "fq"))
    want = {tuple(r) for r in reads.collect()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = text.fastq_scan(spark, str(tmp_path / "fq"))
            assert {tuple(r) for r in got.select("name", "description", "seq", "qual").collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [1, 7, 50, 64, 1000, 1 << 20])
def test_records_are_found_in_any_byte_range(size):
    r = random.Random(size)
    rows = [(f"@r{i} {'x' * (i % 5)}", "ACGT" * (i % 7 + 1), r.choice(["+", f"+r{i}"]), r.choice(["@@+I", "+@II", "IIII", "@+@+"]) * (i % 7 + 1)) for i in range(60)]
    for end in ("\n", "\r\n"):
        data = "".join(end.join(x) + end for x in rows).encode()
        whole = list(fastq.records(io.BytesIO(data), 0, len(data)))
        assert [tuple(x.decode() for x in lines) for _, lines in whole] == rows
        assert [x for a in range(0, len(data), size) for x in fastq.records(io.BytesIO(data), a, a + size)] == whole


def test_fastq_source_equals_the_scan_without_a_shuffle(spark, tmp_path):
    reads = [(f"r{i} some  text " if i % 3 else f"r{i}", "ACGTN"[: i % 6], ("@" + "I" * 5)[: i % 6 if i % 10 else 2]) for i in range(3000)]
    body = "".join(f"@{h}\n{s}\n+\n{q}\n" for h, s, q in reads)
    (tmp_path / "a.fq").write_text(body)
    (tmp_path / "_hidden").write_text("@x\n")
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write(body)
    columns = ["name", "description", "seq", "qual"]
    want = sorted(map(tuple, text.fastq_scan(spark, str(tmp_path)).select(columns).collect()))
    for size in (997, 1 << 20):
        got = fastq.fastq_records(spark, str(tmp_path), range_bytes=size)
        assert sorted(map(tuple, got.select(columns).collect())) == want and "Exchange" not in plan(got)
    assert fastq.fastq_records(spark, f"file://{tmp_path}/a.fq").rdd.getNumPartitions() >= 1
    with pytest.raises(Exception, match="bad FASTQ record"):
        fastq.fastq_records(spark, str(tmp_path), strict=True).collect()


def test_kmers_of_a_genome_in_one_file_are_made_by_many_tasks(spark):
    tiles = frame(spark, DATA, "contig_tiles").coalesce(1)
    for rows in (align.minimizers(tiles), align.paired_index(tiles)):
        assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_exons_are_dealt_by_transcript_before_they_are_collected(spark):
    text = rnaseq.intron_chains(frame(spark, DATA, "exons"))._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_collect_list") < text.index("Exchange")  # the exchange is below


def test_short_ranges_of_a_fastq_file_do_not_become_many_tasks(spark, tmp_path):
    (tmp_path / "a.fq").write_text("".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(5000)))
    got = fastq.fastq_records(spark, str(tmp_path), range_bytes=50)
    assert got.count() == 5000 and got.rdd.getNumPartitions() <= fastq.RANGES + 1


def test_bad_fastq_records(spark, tmp_path):
    (tmp_path / "x.fq").write_text("@a 1\nACGT\n+\nIIII\nb\nACGT\n+\nIIII\n@c\nACG\n+\nIIII\n@d\nA\n-\nI\n")
    assert [r["name"] for r in text.fastq_scan(spark, str(tmp_path)).collect()] == ["a"]
    assert text.bad_fastq(text.numbered_lines(spark, str(tmp_path))).collect()[0]["bad"] == 3
    with pytest.raises(Exception, match="bad FASTQ"):
        text.fastq_scan(spark, str(tmp_path), strict=True).collect()


def test_names_that_occur_twice_pair_by_occurrence(spark):
    schema = "rec long, name string, description string, seq string, qual string"
    a = spark.createDataFrame([(0, "r/1", "", "A", "I"), (1, "r/1", "", "C", "I"), (2, "s/1", "", "G", "I")], schema)
    b = spark.createDataFrame([(0, "r/2", "", "T", "I"), (1, "t/2", "", "G", "I")], schema)
    got = sorted((r["name"], r["status"], len(r["reads"])) for r in text.pair_reads(a, b).collect())
    assert got == [("r", "orphan1", 1), ("r", "paired", 2), ("s", "orphan1", 1), ("t", "orphan2", 1)]


def test_an_existing_dataset_is_an_error(spark, tmp_path):
    text.dataset_sink(spark.range(3), str(tmp_path / "d"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        text.dataset_sink(spark.range(3), str(tmp_path / "d"))


def test_manifest_lines(spark):
    lines = spark.createDataFrame([(0, "a\tb"), (1, "c")], "idx long, value string")
    assert [tuple(r) for r in text.parse_manifest(lines).orderBy("line_no").collect()] == [("a", "b", 0), ("c", None, 1)]
    assert [tuple(r) for r in text.manifest_of(spark, "x , y").orderBy("line_no").collect()] == [("x", "d1", 0), ("y", "d2", 1)]


def test_condition_groups(spark):
    got = rnaseq.parse_condition_groups(spark, "a,b:c,d", "T1,T2").orderBy("file").collect()
    assert [tuple(r) for r in got] == [("a", "T1", 1), ("b", "T1", 2), ("c", "T2", 1), ("d", "T2", 2)]
    assert rnaseq.parse_condition_groups(spark, "a,b", "T1,T2", with_replicates=False).count() == 2
    with pytest.raises(Exception, match="differ in number"):
        rnaseq.parse_condition_groups(spark, "a:b", "T1").collect()


def exon(*rows):
    return [(t, c, s, i + 1, a, b) for t, c, s, ends in rows for i, (a, b) in enumerate(ends)]


def test_class_codes(spark):
    schema = "transcript_id string, contig string, strand string, exon_number int, start long, end long"
    reference = exon(("R1", "c", "+", [(100, 200), (300, 400), (500, 600)]), ("R2", "c", "+", [(5000, 5100), (9000, 9100)]))
    query = exon(
        ("same", "c", "+", [(120, 200), (300, 400), (500, 580)]),
        ("contained", "c", "+", [(150, 200), (300, 380)]),
        ("junction", "c", "+", [(150, 200), (300, 390), (450, 460)]),
        ("overlap", "c", "+", [(190, 250)]),
        ("intron", "c", "-", [(6000, 6100)]),
        ("opposite", "c", "-", [(150, 160)]),
        ("novel", "c", "+", [(20000, 20100)]),
    )
    got = rnaseq.cuffcompare(spark.createDataFrame(query, schema), spark.createDataFrame(reference, schema)).collect()
    assert {r["transcript_id"]: r["class_code"] for r in got} == {
        "same": "=", "contained": "c", "junction": "j", "overlap": "o", "intron": "i", "opposite": "x", "novel": "u",
    }


def test_without_replicates_only_the_fold_change(spark):
    got = rnaseq.diff_expression(frame(spark, DATA, "gene_abundance"), "T1", "T2", with_replicates=False)
    assert got.where("p is not null").count() == 0 < got.where("log2fc is not null").count()


def test_ids_continue_and_stay(spark):
    registry = spark.createDataFrame([("a", "p.7"), ("z", "p.9")], "key string, id string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("b",), (None,)], "key string")
    assert dict(map(tuple, jobs.register_ids(keys, registry, "p").collect())) == {"a": "p.7", "b": "p.10", "c": "p.11"}


def test_equal_call_sets_have_no_diff(spark):
    lines = spark.createDataFrame([("#h",), ("x",), ("x",)], "value string")
    assert variants.vcf_diff(lines, lines.where("value = 'x'")).isEmpty()


def test_plans_have_no_nested_loops(spark):
    reads, tiles = frame(spark, DATA, "reads"), frame(spark, DATA, "contig_tiles")
    for df in (
        intervals.interval_intersect(frame(spark, DATA, "feature_bed"), frame(spark, DATA, "exons")),
        align.align_reads(reads, tiles),
        rnaseq.cuffcompare(frame(spark, DATA, "query_exons"), frame(spark, DATA, "ref_exons")),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_scans_read_the_columns_they_need(spark):
    assert "ReadSchema: struct<p_partkey" in plan(frame(spark, DATA, "contig_tiles"))


def test_fastq_in_one_vcf_with_genotypes_out(spark, tmp_path):
    reads, tiles, contigs = (frame(spark, DATA, t) for t in ("reads", "contig_tiles", "contig_lens"))
    for mate in (1, 2):
        own = reads.where(f"mate = {mate}").select(F.concat_ws("/", "name", "mate").alias("name"), F.lit("").alias("description"), "seq", "qual")
        text.fastq_lines(own).write.text(f"{tmp_path}/{mate}")
    pipelines.snp_file(spark, f"{tmp_path}/1", f"{tmp_path}/2", tiles, contigs, f"{tmp_path}/vcf")
    lines = [r["value"] for r in text.numbered_lines(spark, f"{tmp_path}/vcf", across=True).orderBy("idx").collect()]
    data = [x.split("\t") for x in lines if not x.startswith("#")]
    calls = {(r["contig"], r["pos"], r["alt"]): r["gt"] for r in variants.call_snps(align.align_reads(reads, tiles), tiles).collect()}
    assert {(x[0], int(x[1]), x[4]): x[9] for x in data} == calls and len(data) == len(calls) > 0
    places = [(int(x[0][3:]), int(x[1])) for x in data]
    assert lines[0] == "##fileformat=VCFv4.2" and places == sorted(places)


def test_genotypes_stay_with_the_best_shard(spark):
    shards = spark.createDataFrame([(1, "c1", 5, "A", "C", 30, "0/1"), (0, "c1", 5, "A", "C", 20, "1/1"), (2, "c1", 9, "A", "G", 30, None)], "shard int, contig string, pos long, ref string, alt string, qual long, gt string")
    ranks = spark.createDataFrame([("c1", 20, 1)], "contig string, len long, rank int")
    merged = variants.vcf_merge(shards, ranks)
    assert {r["pos"]: (r["qual"], r["gt"]) for r in merged.collect()} == {5: (30, "0/1"), 9: (30, None)}
    ends = sorted(r["value"].rsplit("\t", 1)[1] for r in text.vcf_lines(merged, ranks).where("rank > 0").collect())
    assert ends == ["./.", "0/1"]


@pytest.mark.parametrize("size", [1, 7, 64, 100_000])
def test_islands_do_not_depend_on_bins(spark, size):
    rng = random.Random(size)
    rows = [("s", "c", f"h{i}", p := rng.randrange(2000), p + rng.choice([0, 3, 9, 120])) for i in range(150)]
    hits = spark.createDataFrame(rows, "sample string, contig string, name string, start long, end long")
    got = [(r.island, r.start, r.end, r.n) for r in rnaseq.assemble_islands(hits, 5, size=size).orderBy("island").collect()]
    want = []
    for *_, start, end in sorted(rows, key=lambda r: r[3:]):
        if want and start <= want[-1][1] + 5:
            want[-1] = (want[-1][0], max(want[-1][1], end), want[-1][2] + 1)
        else:
            want.append((start, end, 1))
    assert got == [(i + 1, *w) for i, w in enumerate(want)]


def test_a_listing_has_files_and_folders(spark, tmp_path):
    (tmp_path / "folder").mkdir()
    (tmp_path / "file.txt").write_text("abc")
    rows = {r.path.rsplit("/", 1)[1]: r for r in text.dataset_listing(spark, f"file://{tmp_path}").collect()}
    assert rows["folder"].is_dir and not rows["file.txt"].is_dir
    assert rows["file.txt"].length == 3 and rows["file.txt"].permission.startswith("rw") and rows["file.txt"].owner


def test_job_states_of_later_batches_replace_earlier_ones(spark, tmp_path):
    source, out, state = (f"file://{tmp_path}/{x}" for x in ("events", "out", "state"))
    columns = "event_id long, job_id string, username string, running_state int, map_progress double, ts timestamp_ntz"
    for rows in ([(1, "a", 1), (2, "b", 1)], [(3, "a", 2)]):
        events = [(i, job, "u", s, 0.5, datetime.datetime(2024, 1, 1, 0, i)) for i, job, s in rows]
        spark.createDataFrame(events, columns).write.mode("append").parquet(source)
        stream.run_to_table(stream.job_status_stream(stream.read_events(spark, source)), out, state).awaitTermination()
    assert {(r.job_id, r.running_state, r.event_id) for r in stream.read_status(spark, out).collect()} == {("a", 2, 3), ("b", 1, 2)}


def test_states_of_ended_jobs_go_and_restarts_change_nothing(spark, tmp_path):
    columns = "event_id long, job_id string, username string, running_state int, map_progress double, ts timestamp_ntz"
    batches = [
        [(1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 1, 1)],
        [(4, "a", 2, 2), (5, "b", 3, 2), (4, "a", 2, 2)],
        [(6, "c", 2, 4), (2, "b", 1, 1), (7, "d", 1, 40)],  # d comes long after the others have ended
        [(8, "d", 5, 41), (9, "a", 1, 42), (10, "z", 2, 90)],  # a starts again
    ]
    for at_once in (True, False):
        source, out, state = (f"file://{tmp_path}/{at_once}/{x}" for x in ("events", "out", "state"))
        sizes = []
        for i, rows in enumerate(batches):
            events = [(e, job, "u", s, 0.5, datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)) for e, job, s, d in rows]
            spark.createDataFrame(events, columns).coalesce(1).write.mode("append").parquet(source)
            if not at_once or i == len(batches) - 1:
                query = stream.run_to_table(stream.ending_status_stream(stream.read_events(spark, source, 1), "2 days"), out, state)
                query.awaitTermination()
                sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        want = {("a", 1, 9), ("b", 3, 5), ("c", 2, 6), ("d", 5, 8), ("z", 2, 10)}
        assert {(r.job_id, r.running_state, r.event_id) for r in stream.read_status(spark, out).collect()} == want
        stream.compact(spark, out)
        stream.compact(spark, out)
        assert {(r.job_id, r.running_state, r.event_id) for r in stream.read_status(spark, out).collect()} == want
        assert len([p for p in os.listdir(out.removeprefix("file://")) if p.startswith("batch=")]) == 1
        if not at_once:
            kept = spark.read.format("statestore").option("stateVarName", "last").load(state).select("key.job_id")
            assert {r[0] for r in kept.collect()} == {"a", "z"}, sizes
