"""A query for each operator, on tables derived from the given ones, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import align, apply, intervals, jobs, recal, rnaseq, variants
from ..plans import pipelines
from ..sources import fastq, text
from ..sources.scratch import scratch, written
from ..streaming import jobs as stream
from .tables import frame, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
BIN = 200  # bases of a genome bin: the derived genome is small


def query(oracle: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that it equals."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql(oracle)
        return f

    return add


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "reads")


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "contig_tiles")


def _aligned(spark: SparkSession, d: str, kept: bool = False) -> DataFrame:
    return align.align_in_batches(_reads(spark, d), _tiles(spark, d), kept)


def _records(spark: SparkSession, d: str, mate: int, drop: int) -> DataFrame:
    """FASTQ records of one mate, without every drop-th."""
    rows = frame(spark, d, "placed_reads").where((F.col("mate") == mate) & (F.col("o") % drop != 1))
    return rows.select(F.lit("f").alias("file"), F.col("o").alias("rec"), F.concat("name", F.lit(f"/{mate}")).alias("name"), F.lit("len=40").alias("description"), "seq", "qual")


def _flat(pairs: DataFrame) -> DataFrame:
    return pairs.select("name", "status", *(_of_mate(m)[c].alias(f"{c}{m}") for m in (1, 2) for c in ("seq", "qual")))


def _of_mate(mate: int):
    return F.get(F.filter("reads", lambda r: r["mate"] == mate), F.lit(0))


# Sources and sinks


@query("SELECT name||'/'||CAST(mate AS STRING) AS name, 'len=40' AS description, seq, qual FROM reads")
def fastq_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "fastq")
    reads = _reads(spark, d).select(F.concat_ws("/", "name", "mate").alias("name"), F.lit("len=40").alias("description"), "seq", "qual", "mate")
    for mate in (1, 2):
        text.fastq_lines(reads.where(F.col("mate") == mate)).write.text(f"{path}/{mate}")
    return text.fastq_scan(spark, [f"{path}/1", f"{path}/2"]).select("name", "description", "seq", "qual")


@query("SELECT name||'/'||CAST(mate AS STRING) AS name, 'len=40' AS description, seq, '@'||substr(qual, 2) AS qual FROM reads")
def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "fastq")
    qual = F.concat(F.lit("@"), F.substring("qual", 2, 1 << 30))  # as a header begins
    reads = _reads(spark, d).select(F.concat_ws("/", "name", "mate").alias("name"), F.lit("len=40").alias("description"), "seq", qual.alias("qual"))
    text.fastq_lines(reads).write.text(path)
    return fastq.fastq_records(spark, path, range_bytes=50_000).select("name", "description", "seq", "qual")


@query("SELECT name, CAST(1 AS INT) AS n_reads, CAST(0 AS INT) AS mate, seq, qual FROM reads WHERE mate = 1")
def single_reads(spark: SparkSession, d: str) -> DataFrame:
    one = text.single_reads(_reads(spark, d).where("mate = 1").withColumn("description", F.lit("")))
    return one.select("name", F.size("reads").alias("n_reads"), F.col("reads")[0]["mate"].alias("mate"), F.col("reads")[0]["seq"].alias("seq"), F.col("reads")[0]["qual"].alias("qual"))


@query("""SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'orphan1' WHEN a.name IS NULL THEN 'orphan2' ELSE 'paired' END AS status,
    a.seq AS seq1, a.qual AS qual1, b.seq AS seq2, b.qual AS qual2
    FROM (SELECT * FROM placed_reads WHERE mate = 1 AND o % 13 <> 1) a FULL JOIN (SELECT * FROM placed_reads WHERE mate = 2 AND o % 17 <> 1) b ON a.name = b.name""")
def pair_reads(spark: SparkSession, d: str) -> DataFrame:
    return _flat(text.pair_reads(_records(spark, d, 1, 13), _records(spark, d, 2, 17)))


@query("""SELECT a.name, CASE WHEN b.name IS NULL THEN 'orphan1' ELSE 'paired' END AS status, a.seq AS seq1, a.qual AS qual1, b.seq AS seq2, b.qual AS qual2
    FROM (SELECT * FROM placed_reads WHERE mate = 1) a LEFT JOIN (SELECT * FROM placed_reads WHERE mate = 2 AND o < (SELECT max(o) FROM placed_reads)) b ON a.name = b.name""")
def pair_reads_interleaved(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "placed_reads")
    last = rows.agg(F.max("o").alias("last"))
    rows = rows.join(F.broadcast(last)).where("mate = 1 or o < last")  # an odd record at the end
    records = rows.select(F.lit("f").alias("file"), (F.col("o") * 2 + F.col("mate") - 1).alias("rec"), F.concat_ws("/", "name", "mate").alias("name"), F.lit("").alias("description"), "seq", "qual")
    return _flat(text.pair_interleaved(records))


def _source_folders(spark: SparkSession, d: str) -> tuple[str, list[str]]:
    path = scratch(spark, "sources")
    frame(spark, d, "source_lines").write.partitionBy("src").text(path)
    return path, [f"{path}/src={i}" for i in range(4)]


@query("SELECT 'd'||CAST(src+1 AS STRING) AS dest, value FROM source_lines")
def manifest_load(spark: SparkSession, d: str) -> DataFrame:
    _, sources = _source_folders(spark, d)
    return text.manifest_load(spark, text.manifest_of(spark, ",".join(sources)))


@query("""SELECT chunk, count(*) AS n, min(value) AS first, max(value) AS last FROM (
    SELECT value, CAST(floor((row_number() OVER (ORDER BY value) - 1)/7) AS BIGINT) AS chunk FROM source_lines) GROUP BY chunk""")
def nline_chunks(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "lines")
    text.sorted_lines(frame(spark, d, "source_lines"), ["value"], path)  # a control list, in order
    chunks = text.nline_chunks(text.numbered_lines(spark, path, across=True), 7)
    return chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))


@query('SELECT transcript_id, gene_id, contig, strand, exon_number, start, "end" AS stop FROM exons')
def gtf_scan(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "gtf")
    text.gtf_lines(frame(spark, d, "exons")).write.text(path)
    a = F.col("attribute")
    return text.gtf_scan(spark, path).select(
        a["transcript_id"].alias("transcript_id"), a["gene_id"].alias("gene_id"), "contig", "strand", a["exon_number"].cast("int").alias("exon_number"), "start", F.col("end").alias("stop")
    )


SAM_CIGARS = "CASE o % 4 WHEN 0 THEN '40M' WHEN 1 THEN '5S35M' WHEN 2 THEN '20M100N20M' ELSE '18M2I10M3D10M' END"


@query("""SELECT name, mate, mate = 2 AS rev, true_contig AS contig, true_pos AS pos, CAST(60 AS INT) AS mapq,
    CAST(CASE o % 4 WHEN 0 THEN 40 WHEN 1 THEN 35 WHEN 2 THEN 140 ELSE 41 END AS BIGINT) AS ref_len, CAST(40 AS BIGINT) AS read_len, o % 4 = 2 AS spliced FROM placed_reads""")
def sam_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "placed_reads")
    flag = (F.col("mate") * 64 + F.when(F.col("mate") == 2, 16).otherwise(0)).cast("string")
    line = F.concat_ws("\t", "name", flag, "true_contig", F.col("true_pos").cast("string"), F.lit("60"), F.expr(SAM_CIGARS), F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")
    path = scratch(spark, "sam")
    frame(spark, d, "contig_lens").select(F.format_string("@SQ\tSN:%s\tLN:%d", "contig", "len").alias("value")).unionByName(rows.select(line.alias("value"))).write.text(path)
    return text.sam_scan(spark.read.text(path)).select("name", "mate", "rev", "contig", "pos", "mapq", "ref_len", "read_len", "spliced")


@query("""SELECT CAST(row_number() OVER (ORDER BY r, pos, ref, alt) - 1 AS BIGINT) AS idx, value FROM (
    SELECT -3 AS r, 0 AS pos, '' AS ref, '' AS alt, '##fileformat=VCFv4.2' AS value
    UNION ALL SELECT -2, rank, '', '', '##contig=<ID='||contig||',length='||CAST(len AS STRING)||'>' FROM ranks
    UNION ALL SELECT -1, 0, '', '', concat_ws(chr(9), '#CHROM','POS','ID','REF','ALT','QUAL','FILTER','INFO','FORMAT','sample')
    UNION ALL SELECT rank, pos, ref, alt, concat_ws(chr(9), contig, CAST(pos AS STRING), '.', ref, alt, CAST(qual AS STRING), '.', '.', 'GT', gt) FROM merged_vcf)""")
def vcf_write(spark: SparkSession, d: str) -> DataFrame:
    ranks = variants.contig_ranks(frame(spark, d, "contig_lens"))
    path = scratch(spark, "vcf")
    text.vcf_write(variants.vcf_merge(frame(spark, d, "vcf_shards"), ranks), ranks, path)
    return text.numbered_lines(spark, path, across=True).select("idx", "value")


@query("SELECT contig, pos FROM known_sites")
def dataset_sink(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "dataset")
    text.dataset_sink(frame(spark, d, "known_sites"), path)
    return spark.read.parquet(path)


@query("SELECT CAST(src AS STRING) AS folder, CAST(sum(length(value)+1) AS BIGINT) AS bytes FROM source_lines GROUP BY src")
def dataset_inventory(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _source_folders(spark, d)
    files = text.dataset_inventory(spark, path).where(F.col("path").endswith(".txt"))
    return files.groupBy(F.regexp_extract("path", r"src=(\d+)/", 1).alias("folder")).agg(F.sum("length").alias("bytes"))


@query("SELECT 'src='||CAST(src AS STRING) AS name, true AS is_dir, true AS complete FROM source_lines GROUP BY src")
def dataset_listing(spark: SparkSession, d: str) -> DataFrame:
    path, _ = _source_folders(spark, d)
    found = text.dataset_listing(spark, path).where("is_dir")
    fields = [F.col(c).isNotNull() for c in ("owner", "group", "permission", "replication", "modification_time", "block_size", "length")]
    return found.select(scalars.base_name(F.col("path")).alias("name"), "is_dir", F.array_min(F.array(*fields)).alias("complete"))


# Projections and filters


@query("""SELECT replace(g, 'kb_', 'kb|') AS genome, mode FROM (SELECT replace(name, '_samtools.tar.gz', '') AS g, m.mode FROM genome_files, (VALUES ('default'),('kb'),('all')) m(mode)
    WHERE contains(name, '_samtools.tar.gz')) WHERE mode = 'all' OR (mode = 'kb') = starts_with(g, 'kb_')""")
def list_genomes(spark: SparkSession, d: str) -> DataFrame:
    files = frame(spark, d, "genome_files")
    modes = {"default": {}, "kb": {"kb": True, "every": True}, "all": {"every": True}}
    parts = [jobs.list_genomes(files, **o).withColumn("mode", F.lit(m)) for m, o in modes.items()]
    return variants.union_shards(*parts)


@query("SELECT * FROM latest WHERE username = 'u3'")
def list_jobs(spark: SparkSession, d: str) -> DataFrame:
    return jobs.list_jobs(frame(spark, d, "job_events"), "u3")


def _gtf(spark: SparkSession, d: str) -> DataFrame:
    attributes = F.format_string('gene_id "%s"; transcript_id "%s"; exon_number "%s";', "gene_id", "transcript_id", F.col("exon_number").cast("string"))
    return frame(spark, d, "exons").withColumn("attributes", attributes)


@query('''SELECT fid, start, "end" AS stop, strand, 'gene_id "'||gene_id||'"; transcript_id "'||transcript_id||'"; exon_number "'||CAST(exon_number AS STRING)||'";' AS attributes, contig FROM overlapping''')
def gtf_project(spark: SparkSession, d: str) -> DataFrame:
    pairs = intervals.interval_intersect(frame(spark, d, "feature_bed"), _gtf(spark, d))
    return intervals.gtf_project(pairs).withColumnRenamed("end", "stop")


def _vcf_text(spark: SparkSession, d: str) -> DataFrame:
    """Merged calls as lines, with one header line a contig."""
    ranks = variants.contig_ranks(frame(spark, d, "contig_lens"))
    merged = variants.vcf_merge(frame(spark, d, "vcf_shards"), ranks)
    return variants.vcf_values(merged).unionByName(ranks.select(F.concat(F.lit("#"), "contig").alias("value")))


VCF_LINE = "concat_ws(chr(9), contig, CAST(pos AS STRING), ref, alt, CAST(qual AS STRING))"


@query(f"SELECT {VCF_LINE} AS value FROM merged_vcf")
def drop_header_lines(spark: SparkSession, d: str) -> DataFrame:
    return text.drop_header_lines(_vcf_text(spark, d))


@query("SELECT name, mate, contig, pos, mapq FROM aligned WHERE mapq > 0 AND list_sum(list_transform(range(1, length(qual)+1), lambda i: ascii(substr(qual, i, 1)) - 33)) >= 28*length(qual)")
def min_quality_filter(spark: SparkSession, d: str) -> DataFrame:
    return variants.min_quality_filter(_aligned(spark, d), 0, 28).select("name", "mate", "contig", "pos", "mapq")


# Joins


@query("SELECT name, mate, rev, contig, pos, seq, qual, nm, mapq FROM aligned")
def align_reads(spark: SparkSession, d: str) -> DataFrame:
    return _aligned(spark, d)


@query("SELECT name, mate, rev, contig, pos, seq, qual, nm, mapq FROM aligned")
def align_with_kept_index(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "index")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    align.save_index(_tiles(spark, d), table, path, 8)
    reads = _reads(spark, d)
    mates = [align.align_reads(reads.where(F.col("mate") == m), _tiles(spark, d), index=spark.table(table)) for m in (1, 2)]
    return variants.union_shards(*mates)


@query("SELECT name, mate, rev, contig, pos, nm, CAST(CASE WHEN ties = 1 THEN 60 ELSE 0 END AS INT) AS mapq FROM every_best")
def align_everywhere(spark: SparkSession, d: str) -> DataFrame:
    reads = frame(spark, d, "worn_reads")
    stage = written if reads.count() > align.SETS_BATCH else None
    return align.align_everywhere(reads, _tiles(spark, d), stage=stage).select("name", "mate", "rev", "contig", "pos", "nm", "mapq")


@query("""SELECT p.name, p.mate, p.rev, p.contig, p.pos, p.nm, c.insert, c.name IS NOT NULL AS proper FROM (
      SELECT p.* FROM places p JOIN (SELECT *, unnest([1, 2]) AS mate FROM pairs_chosen) c ON p.name = c.name AND p.mate = c.mate AND p.contig = c.contig
        AND p.pos = CASE c.mate WHEN 1 THEN c.pos1 ELSE c.pos2 END AND p.rev = ((c.mate = 1) = c.rev1)
      UNION ALL SELECT name, mate, rev, contig, pos, seq, qual, nm FROM aligned WHERE name NOT IN (SELECT name FROM pairs_chosen)) p LEFT JOIN pairs_chosen c ON p.name = c.name""".replace(
    "pairs_chosen",
    """(SELECT * FROM (SELECT a.name, a.contig, a.pos AS pos1, b.pos AS pos2, a.rev AS rev1,
        greatest(a.pos + length(a.seq), b.pos + length(b.seq)) - least(a.pos, b.pos) AS insert,
        row_number() OVER (PARTITION BY a.name ORDER BY a.nm + b.nm, a.contig, a.pos, b.pos, a.rev) AS first
      FROM places a JOIN places b ON a.name = b.name AND a.contig = b.contig AND a.rev <> b.rev AND abs(b.pos - a.pos) <= 500 WHERE a.mate = 1 AND b.mate = 2) WHERE first = 1)"""))  # fmt: skip
def pair_alignments(spark: SparkSession, d: str) -> DataFrame:
    hits = written(align.candidates(_reads(spark, d), _tiles(spark, d)), "hits")
    return align.pair_alignments(hits)


JUNCTIONS = """SELECT contig, donor, acceptor, strand, count(DISTINCT name) AS support FROM (
    SELECT name, contig, l + s AS donor, r + 16 - n + s + 1 AS acceptor, strand, nm, row_number() OVER (PARTITION BY name, strand, contig, l, r ORDER BY nm, s) AS first FROM (
      SELECT x.name, x.contig, x.l, x.r, x.n, x.strand, s,
        CAST(len(list_filter(range(1, n+1), lambda i: substr(x.s1, i, 1) <> CASE WHEN i <= s THEN substr(c.seq, l+i, 1) ELSE substr(c.seq, r+16-n+i, 1) END)) AS INT) AS nm
      FROM (SELECT q.name, q.s1, q.strand, a.contig, a.pos0 AS l, b.pos0 AS r, length(q.s1) AS n, unnest(range(16, length(q.s1)-15)) AS s FROM (
          SELECT name, seq AS s1, '+' AS strand FROM spliced_reads UNION ALL SELECT name, reverse(translate(seq,'ACGT','TGCA')), '-' FROM spliced_reads) q
        JOIN kmers a ON a.kmer = substr(q.s1, 1, 16) JOIN kmers b ON b.kmer = substr(q.s1, length(q.s1)-15, 16) AND b.contig = a.contig
        WHERE b.pos0 - a.pos0 - (length(q.s1) - 16) BETWEEN 20 AND 20000) x JOIN contigs c ON c.contig = x.contig)) WHERE first = 1 AND nm <= 4 GROUP BY ALL"""


@query(JUNCTIONS)
def splice_junctions(spark: SparkSession, d: str) -> DataFrame:
    return align.splice_junctions(frame(spark, d, "spliced_reads"), _tiles(spark, d))


@query('SELECT contig, start0, end0, name, fid, transcript_id, exon_number, start, "end" AS stop, overlap FROM overlapping')
def interval_intersect(spark: SparkSession, d: str) -> DataFrame:
    pairs = intervals.interval_intersect(frame(spark, d, "feature_bed"), frame(spark, d, "exons"))
    return pairs.select("contig", F.col("start0a").alias("start0"), F.col("end0a").alias("end0"), "name", "fid", "transcript_id", "exon_number", "start", F.col("end").alias("stop"), "overlap")


@query("""SELECT x.sample, x.transcript_id, count(DISTINCT h.name) AS n_frag FROM exons x JOIN rna_hits h
    ON h.sample = x.sample AND h.contig = x.contig AND h.strand = x.strand AND h.start <= x."end" AND h."end" >= x.start GROUP BY ALL""")
def reads_in_exons(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.reads_in_exons(frame(spark, d, "rna_hits"), frame(spark, d, "exons"))


@query("SELECT transcript_id, class_code, ref_transcript_id FROM classes")
def cuffcompare(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.cuffcompare(frame(spark, d, "query_exons"), frame(spark, d, "ref_exons"))


@query("SELECT contig, pos, base, n FROM piles p WHERE NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.contig = p.contig AND k.pos = p.pos)")
def mask_known_sites(spark: SparkSession, d: str) -> DataFrame:
    return recal.mask_known_sites(variants.pileup(_aligned(spark, d)), frame(spark, d, "known_sites"))


NEW_QUALS = """SELECT name, mate, string_agg(chr(33 + coalesce(CAST(least(40, greatest(1, round(-10*log10((n_mismatch+1)/(n_obs+2))))) AS INT), reported_q)), '' ORDER BY place) AS qual
    FROM read_bases LEFT JOIN covariates USING (reported_q, cycle, context) GROUP BY name, mate"""


@query(f"SELECT a.name, a.mate, a.contig, a.pos, q.qual FROM aligned a JOIN ({NEW_QUALS}) q ON a.name = q.name AND a.mate = q.mate")
def recalibrate(spark: SparkSession, d: str) -> DataFrame:
    hits = _aligned(spark, d, kept=True)
    table = recal.count_covariates(hits, _tiles(spark, d), frame(spark, d, "known_sites"))
    return recal.recalibrate(hits, table).select("name", "mate", "contig", "pos", "qual")


ASKED = "SELECT CASE WHEN length % 5 = 0 THEN name||'.old' ELSE name END AS name, CASE WHEN length % 7 = 0 THEN 'planet'||CAST(length AS STRING) ELSE 'kb|g.'||CAST(length AS STRING) END AS genome FROM genome_files"


@query(f"""SELECT name, 'missing' AS problem FROM ({ASKED}) WHERE name NOT IN (SELECT name FROM genome_files)
    UNION ALL SELECT DISTINCT genome, 'unsupported genome' FROM ({ASKED}) WHERE genome NOT IN (
      SELECT CASE WHEN starts_with(g, 'kb_') THEN replace(g, 'kb_', 'kb|') ELSE g END FROM (SELECT replace(name, '_samtools.tar.gz', '') AS g FROM genome_files WHERE contains(name, '_samtools.tar.gz')))""")
def validate_inputs(spark: SparkSession, d: str) -> DataFrame:
    files = frame(spark, d, "genome_files")
    asked = spark.sql(ASKED.replace("genome_files", "{files}"), files=files)
    return jobs.validate_inputs(asked, files, jobs.list_genomes(files, every=True))


@query("""SELECT key, id FROM id_registry UNION ALL
    SELECT key, 'kb|sample.'||CAST((SELECT max(CAST(split_part(id, '.', 2) AS BIGINT)) FROM id_registry) + row_number() OVER (ORDER BY key) AS STRING)
    FROM (SELECT DISTINCT key FROM id_keys WHERE key NOT IN (SELECT key FROM id_registry))""")
def register_ids(spark: SparkSession, d: str) -> DataFrame:
    return jobs.register_ids(frame(spark, d, "id_keys"), frame(spark, d, "id_registry"), "kb|sample")


# Aggregations


@query("SELECT contig, pos, base, n FROM piles")
def pileup(spark: SparkSession, d: str) -> DataFrame:
    return variants.pileup(_aligned(spark, d))


@query("SELECT contig, pos, ref, alt, qual, depth, alt_n, gt FROM calls")
def call_snps(spark: SparkSession, d: str) -> DataFrame:
    return variants.call_snps(_aligned(spark, d), _tiles(spark, d))


@query("SELECT reported_q, cycle, context, n_obs, n_mismatch FROM covariates")
def count_covariates(spark: SparkSession, d: str) -> DataFrame:
    return recal.count_covariates(_aligned(spark, d), _tiles(spark, d), frame(spark, d, "known_sites"))


@query("SELECT reported_q, cycle, context, n_obs, n_mismatch FROM covariates")
def merge_covariates(spark: SparkSession, d: str) -> DataFrame:
    hits = _aligned(spark, d, kept=True)
    return recal.merge_covariates(*(recal.count_covariates(hits.where(F.col("mate") == m), _tiles(spark, d), frame(spark, d, "known_sites")) for m in (1, 2)))


@query("SELECT sample, transcript_id, length, n_frag, milli_fpkm FROM abundance")
def transcript_abundance(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.transcript_abundance(frame(spark, d, "rna_hits"), frame(spark, d, "exons"))


@query("""SELECT sample, transcript_id, CAST(length AS BIGINT) AS length, coalesce(n_frag, 0) AS n_frag, coalesce(n_unique, 0) AS n_unique, CAST(amount AS BIGINT) AS micro_frag,
      CAST(amount*1000000 // (length*total) AS BIGINT) AS milli_fpkm
    FROM em_4 JOIN (SELECT sample, count(DISTINCT name) AS total FROM rna_hits GROUP BY ALL) t USING (sample)
    LEFT JOIN (SELECT sample, transcript_id, CAST(sum(n) AS BIGINT) AS n_frag, CAST(sum(CASE WHEN transcripts = transcript_id THEN n ELSE 0 END) AS BIGINT) AS n_unique FROM em_members GROUP BY ALL) c USING (sample, transcript_id)""")
def shared_abundance(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.shared_abundance(frame(spark, d, "rna_hits"), frame(spark, d, "exons"))


@query("SELECT gene_id, n0, n1, log2fc, stat, p FROM tests")
def diff_expression(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.diff_expression(frame(spark, d, "gene_abundance"), "T1", "T2")


METADATA = "SELECT DISTINCT sample, 'kb|g.0' AS genome_id, 'sample '||sample AS title FROM exons"


@query(f"""SELECT m.sample, '{{"sample":"'||m.sample||'","genome_id":"kb|g.0","title":"sample '||m.sample||'","features":{{'||f.doc||'}}}}' AS document
    FROM ({METADATA}) m JOIN (SELECT sample, string_agg('"'||transcript_id||'":'||CAST(milli_fpkm AS STRING), ',' ORDER BY transcript_id) AS doc FROM abundance GROUP BY sample) f ON f.sample = m.sample""")
def expression_object(spark: SparkSession, d: str) -> DataFrame:
    levels = rnaseq.transcript_abundance(frame(spark, d, "rna_hits"), frame(spark, d, "exons"))
    return rnaseq.expression_object(levels.select("sample", F.col("transcript_id").alias("feature"), F.col("milli_fpkm").alias("level")), _metadata(spark, d))


def _metadata(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "exons").select("sample").distinct().select("sample", F.lit("kb|g.0").alias("genome_id"), F.concat(F.lit("sample "), "sample").alias("title"))


@query("""SELECT c_nationkey, c_name AS file, CASE WHEN first THEN 'T1' ELSE 'T2' END AS label, CAST(row_number() OVER (PARTITION BY c_nationkey, first ORDER BY c_name) AS INT) AS replicate
    FROM (SELECT c_nationkey, c_name, c_custkey % 3 = 0 AS first FROM customer) WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) FILTER (WHERE c_custkey % 3 = 0) BETWEEN 1 AND count(*) - 1)""")
def parse_condition_groups(spark: SparkSession, d: str) -> DataFrame:
    files = frame(spark, d, "customer").select("c_nationkey", "c_name", (F.col("c_custkey") % 3 != 0).alias("second"))
    groups = files.groupBy("c_nationkey", "second").agg(F.array_join(F.array_sort(F.collect_list("c_name")), ",").alias("files"))
    options = groups.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("second", "files"))).alias("g")).where(F.size("g") == 2)
    return rnaseq.condition_groups(options.select("c_nationkey", F.array_join("g.files", ":").alias("groups"), F.lit("T1,T2").alias("labels")))


# Windows


@query("SELECT name, mate, contig, pos, rev, nm, mapq FROM aligned")
def best_hit(spark: SparkSession, d: str) -> DataFrame:
    return align.best_hit(align.candidates(_reads(spark, d), _tiles(spark, d))).select("name", "mate", "contig", "pos", "rev", "nm", "mapq")


def _island_sql(source: str, keys: str, order: str, gap: int) -> str:
    return f"""(SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN start > max("end") OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 1
          WHEN row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1 THEN 1 ELSE 0 END AS fresh FROM {source}))"""


@query(f"""SELECT sample, contig, CAST(island AS BIGINT) AS island, min(start) AS start, max("end") AS stop, count(*) AS n
    FROM {_island_sql("rna_hits", "sample, contig", 'start, "end", name', 50)} GROUP BY ALL""")
def assemble_islands(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.assemble_islands(frame(spark, d, "rna_hits")).withColumnRenamed("end", "stop")


@query(f"""SELECT i.contig, i.strand, CAST(island AS BIGINT) AS island, min(start) AS start, max("end") AS stop, count(DISTINCT i.transcript_id) AS n_transcripts, count(DISTINCT chain) AS n_chains
    FROM {_island_sql("exons", "contig, strand", 'start, "end", transcript_id, exon_number', 0)} i JOIN chains c ON c.transcript_id = i.transcript_id GROUP BY i.contig, i.strand, island""")
def merge_transcripts(spark: SparkSession, d: str) -> DataFrame:
    exons = frame(spark, d, "exons")
    parts = [exons.where(F.col("sample") == str(i)) for i in range(1, 6)]
    return rnaseq.merge_transcripts(*parts).withColumnRenamed("end", "stop")


@query("SELECT transcript_id, contig, strand, n_exons, chain FROM chains")
def intron_chains(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.intron_chains(frame(spark, d, "exons"))


@query("SELECT gene_id, log2fc, p, q FROM qvalues")
def bh_qvalues(spark: SparkSession, d: str) -> DataFrame:
    return rnaseq.bh_qvalues(rnaseq.diff_expression(frame(spark, d, "gene_abundance"), "T1", "T2")).select("gene_id", "log2fc", "p", "q")


@query("SELECT job_id, username, running_state, progress, complete, event_id FROM latest")
def latest_job_status(spark: SparkSession, d: str) -> DataFrame:
    return jobs.latest_job_status(frame(spark, d, "job_events"))


# Sorts, partitioning, duplicates, sets


@query("""SELECT contig, start, transcript_id, row_number() OVER (ORDER BY CAST(regexp_extract(contig,'([0-9]+)',1) AS BIGINT), start, transcript_id) - 1 AS idx
    FROM (SELECT DISTINCT contig, start, transcript_id FROM exons)""")
def natural_sort(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "exons").select("contig", "start", "transcript_id").distinct()
    path = scratch(spark, "sorted")
    line = F.concat_ws("\t", "contig", F.col("start").cast("string"), "transcript_id")
    intervals.natural_sort(rows, "contig", "start", "transcript_id").select(line.alias("value")).write.text(path)
    parts = F.split("value", "\t")
    return text.numbered_lines(spark, path, across=True).select(parts[0].alias("contig"), parts[1].cast("bigint").alias("start"), parts[2].alias("transcript_id"), "idx")


@query(f"SELECT contig, CAST(floor((pos-1)/{BIN}) AS BIGINT) AS bin, count(*) AS n FROM ref_bases GROUP BY ALL")
def genome_bins(spark: SparkSession, d: str) -> DataFrame:
    return variants.genome_bins(frame(spark, d, "ref_bases"), BIN).groupBy("contig", "bin").agg(F.count(F.lit(1)).alias("n"))


@query('SELECT transcript_id, contig, fid, start, "end" AS stop, strand FROM deduped')
def dedupe_transcripts(spark: SparkSession, d: str) -> DataFrame:
    pairs = intervals.interval_intersect(frame(spark, d, "feature_bed"), _gtf(spark, d))
    return intervals.dedupe_transcripts(intervals.gtf_project(pairs)).select("transcript_id", "contig", "fid", "start", F.col("end").alias("stop"), "strand")


@query("SELECT rank, contig, pos, ref, alt, qual, shard, gt FROM merged_vcf")
def vcf_merge(spark: SparkSession, d: str) -> DataFrame:
    return variants.vcf_merge(frame(spark, d, "vcf_shards"), variants.contig_ranks(frame(spark, d, "contig_lens")))


@query("SELECT shard, contig, pos, ref, alt, qual, gt FROM vcf_shards UNION ALL SELECT shard, contig, pos, ref, alt, qual, gt FROM vcf_shards WHERE shard = 0")
def union_shards(spark: SparkSession, d: str) -> DataFrame:
    shards = frame(spark, d, "vcf_shards")
    return variants.union_shards(shards, shards.where("shard = 0"))


@query(f"SELECT 'left' AS side, {VCF_LINE} AS line, CAST(1 AS BIGINT) AS n FROM merged_vcf WHERE pos % 50 = 0")
def vcf_diff(spark: SparkSession, d: str) -> DataFrame:
    both = _vcf_text(spark, d)
    fewer = both.where(F.col("value").contains("#") | (F.get(F.split("value", "\t"), F.lit(1)).try_cast("bigint") % 50 != 0))
    return variants.vcf_diff(both.where(~F.col("value").startswith("#chr1")), fewer)


# Scalars


@query("""SELECT c_custkey, replace('kb|g.'||CAST(c_nationkey AS STRING), '|', '_') AS path_id, 'kb|g.'||CAST(c_nationkey AS STRING) AS display_id,
    '' AS empty, replace('-p8,'||c_name, ',', ' ') AS options, c_name AS base, 'gz' AS ext, CAST(trunc((c_custkey % 101)/100.0E0*100) AS INT) AS progress,
    'a::'||c_name||'::kb|g.1___'||c_name AS source_key, 'r1' AS read_key,
    reverse(translate(translate(md5(c_name),'0123456789abcdef','ACGTACGTACGTACGT'),'ACGT','TGCA')) AS revcomp, ascii(substr(c_name,1,1)) - 33 AS q,
    CAST(len(list_filter(range(1, 33), lambda i: substr(translate(md5(c_name),'0123456789abcdef','ACGTACGTACGTACGT'), i, 1)
      <> substr(translate(md5(c_name||'x'),'0123456789abcdef','ACGTACGTACGTACGT'), i, 1))) AS INT) AS hamming FROM customer""")
def scalar_suite(spark: SparkSession, d: str) -> DataFrame:
    genome = F.concat(F.lit("kb|g."), F.col("c_nationkey").cast("string"))
    name = F.col("c_name")
    seq, other = (F.translate(F.md5(c), "0123456789abcdef", "ACGTACGTACGTACGT") for c in (name, F.concat(name, F.lit("x"))))
    return frame(spark, d, "customer").select(
        "c_custkey",
        scalars.to_path_id(genome).alias("path_id"),
        scalars.to_display_id(scalars.to_path_id(genome)).alias("display_id"),
        scalars.or_empty(F.lit(None).cast("string")).alias("empty"),
        scalars.option_list(F.concat(F.lit("-p8,"), name)).alias("options"),
        scalars.base_name(F.concat(F.lit("/data/x/"), name)).alias("base"),
        scalars.extension(F.concat(name, F.lit(".fq.gz"))).alias("ext"),
        scalars.percent((F.col("c_custkey") % 101) / F.lit(100.0)).alias("progress"),
        scalars.source_key(F.concat(F.lit("a "), name), F.lit("g.1")).alias("source_key"),
        scalars.read_key(F.lit("r1/2 len=40")).alias("read_key"),
        scalars.reverse_complement(seq).alias("revcomp"),
        scalars.phred(F.substring(name, 1, 1)).alias("q"),
        scalars.mismatches(scalars.packed(seq, 32), scalars.packed(other, 32)).cast("int").alias("hamming"),
    )


# Streaming and user functions


@query("SELECT job_id, username, running_state, progress, complete, event_id FROM latest")
def job_status_stream(spark: SparkSession, d: str) -> DataFrame:
    source, out, state = (scratch(spark, x) for x in ("events", "status", "state"))
    frame(spark, d, "job_events").repartition(4).write.parquet(source)
    stream.run_to_table(stream.job_status_stream(stream.read_events(spark, source)), out, state).awaitTermination()
    return stream.read_status(spark, out)


@query("SELECT job_id, username, running_state, progress, complete, event_id FROM latest")
def ending_status_stream(spark: SparkSession, d: str) -> DataFrame:
    source, out, state = (scratch(spark, x) for x in ("events", "status", "state"))
    frame(spark, d, "job_events").repartition(4).write.parquet(source)
    events = stream.read_events(spark, source, files_a_batch=2)
    stream.run_to_table(stream.ending_status_stream(events), out, state).awaitTermination()
    stream.compact(spark, out)
    return stream.read_status(spark, out)


def _neighbours(rows: pd.DataFrame) -> pd.DataFrame:
    """For each position, how many rows lie within 100 of it."""
    rows = rows.sort_values("pos")
    at = rows["pos"].to_numpy()
    return rows.assign(near=at.searchsorted(at + 100, "right") - at.searchsorted(at - 100, "left"))[["contig", "pos", "near"]]


@query("SELECT a.contig, a.pos, count(*) AS near FROM known_sites a JOIN known_sites b ON a.contig = b.contig AND abs(a.pos - b.pos) <= 100 GROUP BY a.contig, a.pos")
def apply_per_bin(spark: SparkSession, d: str) -> DataFrame:
    return apply.apply_per_bin(frame(spark, d, "known_sites"), _neighbours, "contig string, pos long, near long", BIN, 100)


@query("SELECT a.contig, a.pos, count(*) AS near FROM known_sites a JOIN known_sites b ON a.contig = b.contig AND abs(a.pos - b.pos) <= 100 GROUP BY a.contig, a.pos")
def apply_per_load(spark: SparkSession, d: str) -> DataFrame:
    return apply.apply_per_load(frame(spark, d, "known_sites"), _neighbours, "contig string, pos long, near long", 3, 100)


@query("""SELECT contig, count(*) AS n, CAST(ceil(count(*) / 50.0) AS BIGINT) AS fair, true AS level FROM (
    SELECT contig, pos FROM ref_bases UNION ALL SELECT contig, pos FROM ref_bases, (SELECT unnest(range(20))) WHERE pos BETWEEN 65 AND 96) GROUP BY contig""")
def load_bins(spark: SparkSession, d: str) -> DataFrame:
    """Bins of a genome with one locus of twenty times the depth: none has over twice the wanted rows."""
    bases = frame(spark, d, "ref_bases").select("contig", "pos")
    deep = bases.unionByName(bases.where("pos between 65 and 96").crossJoin(spark.range(20).drop("id")))
    sizes = variants.in_load_bins(deep, written(variants.load_bins(deep, 50), "bins")).groupBy("contig", "_bin").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("contig").agg(F.sum("n").alias("n"), F.ceil(F.sum("n") / 50).alias("fair"), (F.max("n") <= 100).alias("level"))


def _composition(reads: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"name": reads["name"], "mate": reads["mate"], "gc": reads["seq"].str.count("[GC]").astype("int32")})


@query("SELECT name, mate, CAST(length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')) AS INT) AS gc FROM reads")
def apply_per_read_batch(spark: SparkSession, d: str) -> DataFrame:
    return apply.apply_per_read_batch(_reads(spark, d), _composition, "name string, mate int, gc int")


# Pipelines


@query("""SELECT coalesce(k.rank, 2147483647) AS rank, contig, pos, ref, alt, CAST(qual AS BIGINT) AS qual, gt FROM calls LEFT JOIN ranks k USING (contig)""")
def snp_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.snp_pipeline(_reads(spark, d), _tiles(spark, d), frame(spark, d, "contig_lens"), BIN, align.align_in_batches).drop("shard")


@query("""SELECT CAST(row_number() OVER (ORDER BY r, pos, ref, alt) - 1 AS BIGINT) AS idx, value FROM (
    SELECT -3 AS r, 0 AS pos, '' AS ref, '' AS alt, '##fileformat=VCFv4.2' AS value
    UNION ALL SELECT -2, rank, '', '', '##contig=<ID='||contig||',length='||CAST(len AS STRING)||'>' FROM ranks
    UNION ALL SELECT -1, 0, '', '', concat_ws(chr(9), '#CHROM','POS','ID','REF','ALT','QUAL','FILTER','INFO','FORMAT','sample')
    UNION ALL SELECT rank, pos, ref, alt, concat_ws(chr(9), contig, CAST(pos AS STRING), '.', ref, alt, CAST(qual AS STRING), '.', '.', 'GT', gt) FROM calls JOIN ranks USING (contig))""")
def snp_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "snp")
    reads = _reads(spark, d).select(F.concat_ws("/", "name", "mate").alias("name"), F.lit("len=40").alias("description"), "seq", "qual", "mate")
    for mate in (1, 2):
        text.fastq_lines(reads.where(F.col("mate") == mate)).write.text(f"{path}/{mate}")
    pipelines.snp_file(spark, f"{path}/1", f"{path}/2", _tiles(spark, d), frame(spark, d, "contig_lens"), f"{path}/vcf", BIN)
    return text.numbered_lines(spark, f"{path}/vcf", across=True).select("idx", "value")


@query("SELECT coalesce(k.rank, 2147483647) AS rank, contig, pos, ref, alt, CAST(qual AS BIGINT) AS qual, gt FROM recalled LEFT JOIN ranks k USING (contig)")
def recalibrated_calls(spark: SparkSession, d: str) -> DataFrame:
    hits = _aligned(spark, d, kept=True)
    return pipelines.recalibrated_calls(hits, _tiles(spark, d), frame(spark, d, "contig_lens"), BIN, written).drop("shard")


@query("SELECT coalesce(k.rank, 2147483647) AS rank, contig, pos, ref, alt, CAST(qual AS BIGINT) AS qual, gt FROM firm_recalled LEFT JOIN ranks k USING (contig)")
def recalibrated_calls_of_two_qualities(spark: SparkSession, d: str) -> DataFrame:
    two = F.translate("qual", "56789:;<=>?@ABCD", "55555555????????")
    hits = _aligned(spark, d, kept=True).withColumn("qual", two)
    return pipelines.recalibrated_calls(hits, _tiles(spark, d), frame(spark, d, "contig_lens"), BIN, written).drop("shard")


@query(f"""SELECT l.locus, l.contig, l.strand, l.start, l."end" AS stop, l.n_transcripts, coalesce(n.n, 0) AS n_junctions, q.log2fc, q.p, q.q,
      coalesce(split_part('=,c,j,o,i,x', ',', c.code+1), 'u') AS class_code, c.ref_transcript_id
    FROM loci l LEFT JOIN locus_qvalues q ON q.gene_id = l.locus LEFT JOIN locus_classes c ON c.locus = l.locus
    LEFT JOIN (SELECT x.locus, count(*) AS n FROM loci x JOIN ({JUNCTIONS}) j ON j.contig = x.contig AND j.strand = x.strand AND j.donor < x."end" AND j.acceptor > x.start GROUP BY x.locus) n ON n.locus = l.locus""")
def rnaseq_from_reads(spark: SparkSession, d: str) -> DataFrame:
    conditions = {"1": "T1", "2": "T1", "3": "T2", "4": "T2", "5": "T2"}
    loci = pipelines.rnaseq_from_reads(frame(spark, d, "spliced_reads"), _tiles(spark, d), frame(spark, d, "rna_hits"), frame(spark, d, "ref_exons"), conditions, written)
    return loci.withColumnRenamed("end", "stop")


@query("""SELECT transcript_id, m.contig, m.strand, CAST(len(string_split(coalesce(introns||',', ''), ',')) AS BIGINT) AS n_exons, m.start, m."end" AS stop, n_samples, gene_id, log2fc, p, q, class_code, ref_transcript_id
    FROM rna_models m JOIN rna_gene_of USING (transcript_id) LEFT JOIN study_qvalues USING (gene_id) LEFT JOIN study_classes USING (transcript_id)""")
def rnaseq_study(spark: SparkSession, d: str) -> DataFrame:
    conditions = {"1": "T1", "2": "T1", "3": "T2", "4": "T2"}
    reads = frame(spark, d, "rna_reads")
    return pipelines.rnaseq_study(reads, _tiles(spark, d), frame(spark, d, "rna_ref_exons"), conditions).withColumnRenamed("end", "stop")


@query("""SELECT q.gene_id, log2fc, p, q, n_transcripts, n_matched FROM fpkm_qvalues q JOIN (
    SELECT gene_id, count(*) AS n_transcripts, count(*) FILTER (WHERE class_code IN ('=','c','j')) AS n_matched
    FROM classes JOIN (SELECT DISTINCT transcript_id, gene_id FROM query_exons) g USING (transcript_id) GROUP BY gene_id) c ON c.gene_id = q.gene_id""")
def rnaseq_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.rnaseq_pipeline(frame(spark, d, "rna_hits"), frame(spark, d, "exons"), frame(spark, d, "query_exons"), frame(spark, d, "ref_exons"), "1", "2")


@query(f"""SELECT m.sample, '{{"sample":"'||m.sample||'","genome_id":"kb|g.0","title":"sample '||m.sample||'","features":{{'||f.doc||'}}}}' AS document
    FROM ({METADATA}) m JOIN (SELECT sample, string_agg('"'||transcript_id||'":'||CAST("end"-start+1 AS STRING), ',' ORDER BY transcript_id) AS doc FROM deduped GROUP BY sample) f ON f.sample = m.sample""")
def annotate_transcripts(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.annotate_transcripts(frame(spark, d, "feature_bed"), _gtf(spark, d), _metadata(spark, d))
