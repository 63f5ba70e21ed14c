"""Text formats: numbered lines, FASTQ, GTF, SAM, VCF, manifests, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import read_key

GTF_COLUMNS = "contig STRING, source STRING, feature STRING, start BIGINT, `end` BIGINT, score STRING, strand STRING, frame STRING, attributes STRING"


def numbered_lines(spark: SparkSession, paths: str | list[str], across: bool = False) -> DataFrame:
    """(file, idx, value): lines numbered from 0 in each file, however it was split; ``across`` files in name order if so asked.

    A split is read by one task in order, so its lines have consecutive
    increasing ids. The lines themselves are not shuffled: only the first id and
    the number of lines of each split are summed up and joined to them.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"), "value"
    )
    splits = lines.groupBy("file", "block").agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("file", "block") if across else Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each split
    offsets = F.broadcast(splits.select("file", "block", (before - F.col("first")).alias("offset")))  # bounded by the files' size: some 100 bytes for each split
    return lines.join(offsets, ["file", "block"]).select("file", (F.col("m") + F.col("offset")).alias("idx"), "value")


def nline_chunks(lines: DataFrame, n: int = 1) -> DataFrame:
    """``lines(file, idx, value)`` with chunk numbers: n lines each, the last one short."""
    return lines.withColumn("chunk", F.floor(F.col("idx") / n).cast("bigint"))


def parse_fastq(lines: DataFrame, strict: bool = False) -> DataFrame:
    """(file, rec, name, description, seq, qual) of numbered lines, four a record.

    A record is bad if its header lacks @, its third line lacks +, or sequence
    and quality differ in length. Bad records are dropped, or fail the job if
    ``strict``; :func:`bad_fastq` counts them.
    """
    rows = _fastq_records(lines)
    if strict:
        rows = rows.withColumn("good", F.when(F.col("good"), True).otherwise(F.raise_error(F.concat(F.lit("bad FASTQ record "), F.col("rec").cast("string"))).cast("boolean")))
    return rows.where("good").drop("good")


def bad_fastq(lines: DataFrame) -> DataFrame:
    """(file, bad): bad records of each file."""
    return _fastq_records(lines).groupBy("file").agg(F.count_if(~F.col("good")).alias("bad"))


def _fastq_records(lines: DataFrame) -> DataFrame:
    role = F.col("idx") % 4
    line = {k: F.max(F.when(role == i, F.col("value"))).alias(k) for i, k in enumerate(("header", "seq", "plus", "qual"))}
    rows = lines.groupBy("file", F.floor(F.col("idx") / 4).cast("bigint").alias("rec")).agg(*line.values())
    good = F.coalesce(F.col("header").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual")), F.lit(False))
    head = F.substring(F.col("header"), 2, 1 << 30)
    return rows.select(
        "file", "rec", F.regexp_extract(head, r"^(\S*)", 1).alias("name"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), "seq", "qual", good.alias("good")
    )


def fastq_scan(spark: SparkSession, paths: str | list[str], strict: bool = False) -> DataFrame:
    """FASTQ files, plain or compressed by extension, as read records."""
    return parse_fastq(numbered_lines(spark, paths), strict)


def fastq_lines(reads: DataFrame) -> DataFrame:
    """One value of four lines for each read (name, description, seq, qual)."""
    return reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "name", F.when(F.col("description") != "", F.concat(F.lit(" "), "description")).otherwise("")), "seq", F.lit("+"), "qual").alias("value"))


def single_reads(reads: DataFrame) -> DataFrame:
    """(name, reads): a collection of one read each."""
    return reads.select("name", F.array(F.struct(F.lit(0).alias("mate"), "seq", "description", "qual")).alias("reads"))


def _read(mate: int, side: str = "") -> Column:
    return F.struct(F.lit(mate).alias("mate"), *(F.col(f"{side}{c}").alias(c) for c in ("seq", "description", "qual")))


def pair_reads(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates joined by name: (name, reads, status), status paired, orphan1 or orphan2.

    Names lose /1 and /2; a name that occurs more than once in a file pairs by occurrence.
    """
    sides = []
    for side, df in (("a_", first), ("b_", second)):
        key = read_key(F.col("name"))
        n = F.row_number().over(Window.partitionBy(key).orderBy("rec"))
        sides.append(df.select(key.alias("name"), n.alias("occurrence"), *(F.col(c).alias(side + c) for c in ("seq", "description", "qual"))))
    both = sides[0].join(sides[1], ["name", "occurrence"], "full_outer")
    one, two = F.col("a_seq").isNotNull(), F.col("b_seq").isNotNull()
    reads = F.when(one & two, F.array(_read(1, "a_"), _read(2, "b_"))).when(one, F.array(_read(1, "a_"))).otherwise(F.array(_read(2, "b_")))
    return both.select("name", reads.alias("reads"), F.when(one & two, "paired").when(one, "orphan1").otherwise("orphan2").alias("status"))


def pair_interleaved(reads: DataFrame) -> DataFrame:
    """Records 2i and 2i+1 of a file as pair i; an odd one at the end is orphan1."""
    item = F.struct((F.col("rec") % 2 + 1).cast("int").alias("mate"), "seq", "description", "qual", "name")
    pairs = reads.groupBy("file", F.floor(F.col("rec") / 2).cast("bigint").alias("pair")).agg(F.array_sort(F.collect_list(item)).alias("r"))
    drop = F.transform("r", lambda x: F.struct(x["mate"].alias("mate"), x["seq"].alias("seq"), x["description"].alias("description"), x["qual"].alias("qual")))
    status = F.when(F.size("r") == 2, "paired").otherwise("orphan1")
    return pairs.select("file", "pair", read_key(F.col("r")[0]["name"]).alias("name"), drop.alias("reads"), status.alias("status"))


def manifest_of(spark: SparkSession, sources: str) -> DataFrame:
    """(src, dest, line_no) of a comma list: destinations d1, d2, ..."""
    one = spark.range(1).select(F.posexplode(F.split(F.lit(sources), r"\s*,\s*")).alias("i", "src"))
    return one.select("src", F.concat(F.lit("d"), (F.col("i") + 1).cast("string")).alias("dest"), F.col("i").alias("line_no"))


def parse_manifest(lines: DataFrame) -> DataFrame:
    """(src, dest, line_no) of tab-separated lines (idx, value)."""
    parts = F.split("value", "\t")
    return lines.select(parts[0].alias("src"), F.get(parts, F.lit(1)).alias("dest"), F.col("idx").alias("line_no"))


def _plain_path(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^file:(//)?", ""), r"/$", "")


def manifest_load(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(dest, value): the lines of every source (a file or a folder) of a manifest, under its destination."""
    paths = [r["src"] for r in manifest.select("src").collect()]  # a manifest lists files, not data
    lines = spark.read.text(paths).select("value", _plain_path(F.col("_metadata.file_path")).alias("file"))
    keyed = lines.select("value", F.explode(F.array("file", F.regexp_replace("file", "/[^/]*$", ""))).alias("src"))
    return keyed.join(manifest.select(_plain_path(F.col("src")).alias("src"), "dest"), "src").select("dest", "value")


def gtf_scan(spark: SparkSession, path: str) -> DataFrame:
    """GTF as columns, attributes as a map and their text."""
    rows = spark.read.schema(GTF_COLUMNS).csv(path, sep="\t", comment="#", quote="")
    pattern = r'(\w+) "([^"]*)"'
    keys, values = (F.regexp_extract_all("attributes", F.lit(pattern), F.lit(i)) for i in (1, 2))
    return rows.withColumn("attribute", F.map_from_arrays(keys, values))


def gtf_lines(exons: DataFrame) -> DataFrame:
    """GTF lines of exons(transcript_id, gene_id, contig, strand, exon_number, start, end)."""
    attributes = F.format_string('gene_id "%s"; transcript_id "%s"; exon_number "%s";', "gene_id", "transcript_id", F.col("exon_number").cast("string"))
    return exons.select(F.concat_ws("\t", "contig", F.lit("fixture"), F.lit("exon"), "start", "end", F.lit("."), "strand", F.lit("."), attributes).alias("value"))


def sam_scan(lines: DataFrame) -> DataFrame:
    """Alignments of SAM lines: flag bits as columns, extents from the CIGAR; headers dropped."""
    f = F.split("value", "\t")
    cigar = f[5]
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    kinds = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    ops = F.zip_with(lengths, kinds, lambda n, k: F.struct(n.cast("bigint").alias("n"), k.alias("k")))

    def extent(kinds_: str) -> Column:
        return F.aggregate(ops, F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(F.instr(F.lit(kinds_), x["k"]) > 0, x["n"]).otherwise(0))

    flag = f[1].cast("int")
    return lines.where(~F.col("value").startswith("@")).select(
        f[0].alias("name"),
        F.when(flag.bitwiseAND(64) > 0, 1).when(flag.bitwiseAND(128) > 0, 2).otherwise(0).alias("mate"),
        (flag.bitwiseAND(16) > 0).alias("rev"),
        f[2].alias("contig"), f[3].cast("bigint").alias("pos"), f[4].cast("int").alias("mapq"), cigar.alias("cigar"),
        extent("MDN=X").alias("ref_len"), extent("MIS=X").alias("read_len"), (F.array_contains(kinds, "N")).alias("spliced"),
        f[9].alias("seq"), f[10].alias("qual"),
    )


def vcf_lines(calls: DataFrame, contigs: DataFrame, sample: str = "sample") -> DataFrame:
    """(rank, pos, ref, alt, value): header and data lines, to be sorted by the first four.

    ``calls(contig, pos, ref, alt, qual, gt)`` and ``contigs(contig, len, rank)``; without ``gt`` no genotype is known.
    """
    head = calls.sparkSession.createDataFrame([(-3, "##fileformat=VCFv4.2")], "k int, value string").select(F.lit(-3).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("ref"), F.lit("").alias("alt"), "value")
    lens = contigs.select(
        F.lit(-2).cast("bigint").alias("rank"), F.col("rank").cast("bigint").alias("pos"), F.lit("").alias("ref"), F.lit("").alias("alt"),
        F.format_string("##contig=<ID=%s,length=%s>", "contig", F.col("len").cast("string")).alias("value"),
    )
    names = head.select(F.lit(-1).cast("bigint").alias("rank"), "pos", "ref", "alt", F.lit("\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", sample])).alias("value"))
    gt = F.coalesce("gt", F.lit("./.")) if "gt" in calls.columns else F.lit("./.")
    data = calls.drop("rank").join(contigs.select("contig", "rank"), "contig", "left").select(
        F.coalesce(F.col("rank").cast("bigint"), F.lit(1 << 62)).alias("rank"), F.col("pos").cast("bigint").alias("pos"), "ref", "alt",
        F.concat_ws("\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.col("qual").cast("string"), F.lit("."), F.lit("."), F.lit("GT"), gt).alias("value"),
    )
    return head.unionByName(lens).unionByName(names).unionByName(data)


def sorted_lines(lines: DataFrame, order: list, path: str) -> None:
    """Write ``lines(value, ...)`` in order: sorted by ranges, a file a range, whose names are in order too.

    The files one after the other are the whole text; :func:`numbered_lines` numbers them ``across``.
    """
    lines.orderBy(*order).select("value").write.mode("errorifexists").text(path)


def vcf_write(calls: DataFrame, contigs: DataFrame, path: str) -> None:
    """A VCF as a folder of files in order, the first of them with the header; an existing path is an error."""
    sorted_lines(vcf_lines(calls, contigs), ["rank", "pos", "ref", "alt"], path)


def drop_header_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").contains("#"))


def dataset_sink(df: DataFrame, path: str) -> None:
    """Write a dataset; an existing path is an error."""
    df.write.mode("errorifexists").parquet(path)


def dataset_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modification_time) of the files below a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(_plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modification_time"))


def dataset_listing(spark: SparkSession, path: str) -> DataFrame:
    """What lies directly in a folder, files and folders, with all fields of a file's status.

    (is_dir, path, owner, group, permission, replication, modification_time,
    block_size, length). One folder's listing is one call of the file system,
    which Spark has no table for; use :func:`dataset_inventory` for whole trees.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    rows = [
        (s.isDirectory(), s.getPath().toString(), s.getOwner(), s.getGroup(), s.getPermission().toString(), s.getReplication(), s.getModificationTime(), s.getBlockSize(), s.getLen())
        for s in found
    ]
    schema = "is_dir boolean, path string, owner string, `group` string, permission string, replication int, millis long, block_size long, length long"
    listed = spark.createDataFrame(rows, schema)
    return listed.select("is_dir", _plain_path(F.col("path")).alias("path"), "owner", "group", "permission", "replication", F.timestamp_millis("millis").alias("modification_time"), "block_size", "length")
