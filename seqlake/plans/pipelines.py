"""The composed pipelines: one lazy plan each."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import natural_key, read_key
from ..operators import align, assembly, intervals, recal, rnaseq, variants
from ..sources import text
from ..sources.scratch import written


def _merged(calls: DataFrame, contigs: DataFrame, bin_size: int) -> DataFrame:
    shards = calls.withColumn("shard", F.floor((F.col("pos") - 1) / bin_size).cast("int"))
    return variants.vcf_merge(shards.select("shard", "contig", "pos", "ref", "alt", "qual", "gt"), variants.contig_ranks(contigs))


def snp_pipeline(
    reads: DataFrame, tiles: DataFrame, contigs: DataFrame, bin_size: int = 1_000_000, aligner: Callable[[DataFrame, DataFrame], DataFrame] = align.align_reads
) -> DataFrame:
    """Align, call and merge: (rank, contig, pos, ref, alt, qual, shard, gt). One plan, but for an ``aligner`` that writes its hits (:func:`align.align_in_batches`)."""
    return _merged(variants.call_snps(aligner(reads, tiles), tiles), contigs, bin_size)


def snp_file(spark: SparkSession, first: str, second: str, tiles: DataFrame, contigs: DataFrame, out: str, bin_size: int = 1_000_000) -> None:
    """FASTQ files of both mates in, one VCF with genotypes out, in a folder of files in order."""
    mates = [text.fastq_scan(spark, [path]).select(read_key(F.col("name")).alias("name"), F.lit(mate).alias("mate"), "seq", "qual") for mate, path in ((1, first), (2, second))]
    calls = snp_pipeline(variants.union_shards(*mates), tiles, contigs, bin_size)
    text.vcf_write(calls, variants.contig_ranks(contigs), out)


def recalibrated_calls(
    alignments: DataFrame, tiles: DataFrame, contigs: DataFrame, bin_size: int = 1_000_000, stage: Callable[[DataFrame, str], DataFrame] = lambda df, label: df
) -> DataFrame:
    """Call, count covariates off the calls by mate and merge them, recalibrate, call again, merge.

    ``alignments`` are read three times: give a written table. The first calls and the covariates, which are small beside what they
    shuffle, go through ``stage``: with :func:`seqlake.sources.scratch.written` the disk holds the shuffles of one step at a time.
    """
    first = stage(_merged(variants.call_snps(alignments, tiles), contigs, bin_size), "calls")
    shards = [stage(recal.count_covariates(alignments.where(F.col("mate") == m), tiles, first), "covariates") for m in (1, 2)]
    better = recal.recalibrate(alignments, stage(recal.merge_covariates(*shards), "covariates"))
    return _merged(variants.call_snps(better, tiles), contigs, bin_size)


def rnaseq_pipeline(hits: DataFrame, exons: DataFrame, assembled: DataFrame, reference: DataFrame, first: str, second: str) -> DataFrame:
    """(gene_id, log2fc, p, q, n_transcripts, n_matched): expression of all exons, comparison of the assembled ones.

    Samples are the conditions, transcripts of a gene its replicates; matched
    are transcripts that the comparison with the reference classes as =, c or j.
    """
    levels = rnaseq.transcript_abundance(hits, exons)
    genes = exons.select("transcript_id", "gene_id").distinct()
    amounts = levels.join(genes, "transcript_id").select("gene_id", F.col("sample").alias("condition"), F.col("milli_fpkm").alias("amount"))
    tests = rnaseq.bh_qvalues(rnaseq.diff_expression(amounts, first, second))
    classes = rnaseq.cuffcompare(assembled, reference).join(genes, "transcript_id").groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("n_transcripts"), F.count_if(F.col("class_code").isin("=", "c", "j")).alias("n_matched")
    )
    return tests.join(classes, "gene_id").select("gene_id", "log2fc", "p", "q", "n_transcripts", "n_matched")


def rnaseq_from_reads(
    reads: DataFrame, tiles: DataFrame, hits: DataFrame, reference: DataFrame, conditions: Mapping[str, str], stage: Callable[[DataFrame, str], DataFrame] = lambda df, label: df
) -> DataFrame:
    """(locus, contig, strand, start, end, n_transcripts, n_junctions, log2fc, p, q, class_code, ref_transcript_id).

    Junctions of spliced ``reads``; blocks assembled from the hits of each sample
    and strand; loci merged over samples; expression of every locus in every
    sample, tested between the two conditions; comparison of the loci with the
    ``reference``. ``conditions`` names the condition of each sample, as a study
    lists them; the first and last label in order are compared. Each table of
    the chain goes through ``stage``: with :func:`seqlake.sources.scratch.written`
    the disk holds the shuffles of one of them at a time.
    """
    place = ["contig", "strand"]
    junctions = stage(align.splice_junctions(reads, tiles), "junctions")
    blocks = rnaseq.assemble_islands(hits, keys=("sample", *place))
    blocks = blocks.withColumn("transcript_id", F.concat_ws(".", "sample", *place, F.col("island").cast("string"))).withColumn("exon_number", F.lit(1))
    loci = rnaseq.merge_transcripts(blocks.drop("island", "n"))
    loci = loci.withColumn("locus", F.concat_ws(".", *place, F.col("island").cast("string"))).select("locus", *place, "start", "end", "n_transcripts")
    loci = stage(loci, "loci")

    samples = F.array(*map(F.lit, sorted(conditions)))
    exons = loci.withColumn("sample", F.explode(samples)).withColumnRenamed("locus", "transcript_id")
    levels = stage(rnaseq.transcript_abundance(hits, exons), "levels")
    condition = F.create_map(*(F.lit(x) for pair in sorted(conditions.items()) for x in pair))[F.col("sample")]
    amounts = levels.select(F.col("transcript_id").alias("gene_id"), condition.alias("condition"), F.col("milli_fpkm").alias("amount"))
    labels = sorted(set(conditions.values()))
    tests = rnaseq.bh_qvalues(rnaseq.diff_expression(amounts, labels[0], labels[-1])).select(F.col("gene_id").alias("locus"), "log2fc", "p", "q")

    own = loci.select(F.col("locus").alias("transcript_id"), *place, F.lit(1).alias("exon_number"), "start", "end")
    classes = stage(rnaseq.cuffcompare(own, reference).withColumnRenamed("transcript_id", "locus"), "classes")
    introns = junctions.select(*place, F.col("donor").alias("start0a"), (F.col("acceptor") - 1).alias("end0a"))
    spans = loci.select("locus", *place, (F.col("start") - 1).alias("start0b"), F.col("end").alias("end0b"))
    spanned = stage(intervals.nested_overlap_join(introns, spans, place).groupBy("locus").agg(F.count(F.lit(1)).alias("n_junctions")), "spanned")
    return (
        loci.join(tests, "locus", "left").join(classes, "locus", "left").join(spanned, "locus", "left")
        .withColumn("n_junctions", F.coalesce("n_junctions", F.lit(0)))
        .select("locus", *place, "start", "end", "n_transcripts", "n_junctions", "log2fc", "p", "q", "class_code", "ref_transcript_id")
    )


def rnaseq_study(reads: DataFrame, tiles: DataFrame, reference: DataFrame, conditions: Mapping[str, str], min_support: int = 2) -> DataFrame:
    """(transcript_id, contig, strand, n_exons, start, end, n_samples, gene_id, log2fc, p, q, class_code, ref_transcript_id).

    From ``reads(sample, name, seq)`` alone: placed whole or spliced; a splice
    graph of each sample and its heaviest paths as transcripts; equal ones
    merged over samples; abundance of each in each sample; genes, as stretches
    of overlapping transcripts, tested between the first and last condition in
    order; transcripts classed by the ``reference`` exons. Placed reads and
    transcripts are written tables, as several steps read them.
    """
    place = ["contig", "strand"]
    placed = written(assembly.place_rna_reads(reads, tiles), "placed")
    exons = written(assembly.merge_assemblies(assembly.assemble_transcripts(placed, min_support)), "models")
    models = exons.groupBy("transcript_id", *place, "n_samples").agg(F.count(F.lit(1)).alias("n_exons"), F.min("start").alias("start"), F.max("end").alias("end"))
    loci = rnaseq.assemble_islands(models, 0, place).select(*place, F.col("start").alias("first"), (F.col("start") - 1).alias("start0b"), F.col("end").alias("end0b"))
    spans = models.withColumns({"start0a": F.col("start") - 1, "end0a": F.col("start")})
    genes = intervals.overlap_join(spans, loci, place, 1000).withColumn("gene_id", F.concat_ws(".", *place, F.col("first").cast("string")))
    genes = genes.drop("first", "start0a", "end0a", "start0b", "end0b")

    samples = F.array(*map(F.lit, sorted(conditions)))
    levels = rnaseq.transcript_abundance(assembly.block_hits(placed), exons.withColumn("sample", F.explode(samples)))
    condition = F.create_map(*(F.lit(x) for pair in sorted(conditions.items()) for x in pair))[F.col("sample")]
    amounts = levels.join(genes.select("transcript_id", "gene_id"), "transcript_id").groupBy("sample", "gene_id").agg(F.sum("milli_fpkm").alias("amount"))
    labels = sorted(set(conditions.values()))
    tests = rnaseq.bh_qvalues(rnaseq.diff_expression(amounts.withColumn("condition", condition), labels[0], labels[-1])).select("gene_id", "log2fc", "p", "q")
    classes = rnaseq.cuffcompare(exons, reference)
    columns = ["transcript_id", *place, "n_exons", "start", "end", "n_samples", "gene_id", "log2fc", "p", "q", "class_code", "ref_transcript_id"]
    return genes.join(tests, "gene_id", "left").join(classes, "transcript_id", "left").select(*columns)


def annotate_transcripts(features: DataFrame, gtf: DataFrame, metadata: DataFrame) -> DataFrame:
    """Sort by place, intersect, project, dedupe, one document a sample: level is the exon's length.

    gtf: sample, contig, start, end, strand, attributes. The sort deals the
    exons by ranges of their natural place, as the files of the chain are; which row
    of a transcript stays is its first in that order.
    """
    placed = gtf.repartitionByRange(*natural_key(F.col("contig")), "start").sortWithinPartitions(*natural_key(F.col("contig")), "start")
    pairs = intervals.interval_intersect(features, placed)
    rows = intervals.dedupe_transcripts(intervals.gtf_project(pairs))
    samples = gtf.select(intervals.transcript_of(F.col("attributes")).alias("transcript_id"), "sample").distinct()
    levels = rows.join(samples, "transcript_id").select("sample", F.col("transcript_id").alias("feature"), (F.col("end") - F.col("start") + 1).alias("level"))
    return rnaseq.expression_object(levels, metadata)
