"""Secret scans over an incremental ledger of blobs.

A text is a blob, addressed by its SHA-256. The ledger is a table of findings
with one mark for every blob and rule version scanned. A scan takes the blobs
of all rows given, leaves out the pairs of blob and rule version that the ledger
has, scans what is left once however many rows hold it, appends to the ledger
and joins the findings back to every row. All of it is DataFrame functions.

A rule's matches are leftmost and non-overlapping; the places come from the
lengths of the gaps between them, summed along each blob.

Edge cases: null text is the empty text; null and repeated ids and copies get
their own rows; an empty table gives no rows and an unchanged ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int  # its length is tested
    least: int
    version: int = 1

    @property
    def label(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", r"((?i)password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)
RULES = BASE + MORE


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, start, end) of ``blobs(blob, text, todo)``, with a null place as the mark of each pair."""
    text = F.col("text")

    def found(rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        probe = rule.pattern if rule.kind != "hex" else rf"[0-9a-f]{{{rule.least}}}"  # cheaper, and no less is kept
        parts = F.arrays_zip(
            F.split(text, rule.pattern, -1).alias("gap"),
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        )
        lengths = F.transform(
            parts, lambda p: F.struct(F.char_length(p["gap"]).alias("gap"), F.char_length(p["match"]).alias("match"), F.char_length(p["value"]).alias("value"))
        )
        return F.struct(
            F.lit(rule.label).alias("rule"),
            F.lit(rule.least).alias("least"),
            F.when(F.array_contains("todo", rule.label) & F.rlike(text, F.lit(probe)), lengths).alias("parts"),
        )

    rows = blobs.select("blob", "todo", F.explode(F.array(*map(found, rules))).alias("r")).where(F.array_contains("todo", F.col("r.rule")))
    rows = rows.select("blob", "r.rule", "r.least", F.posexplode_outer("r.parts").alias("pos", "p")).select("blob", "rule", "least", "pos", "p.*")
    along = Window.partitionBy("blob", "rule").orderBy("pos")
    end = F.sum(F.col("gap") + F.coalesce("match", F.lit(0))).over(along)
    rows = rows.select("blob", "rule", "least", "pos", "match", "value", end.alias("end"))
    mark = F.coalesce("pos", F.lit(0)) == 0
    place = F.col("match").isNotNull() & (F.col("value") >= F.col("least"))
    return rows.where(mark | place).select(
        "blob", "rule", F.when(place, F.col("end") - F.col("match")).alias("start"), F.when(place, F.col("end")).alias("end"), mark.alias("mark")
    )


class Ledger:
    """A folder of Parquet files: (blob, rule, start, end, mark)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or shared_dir(spark, "ledger")

    def rows(self) -> DataFrame:
        """The ledger's rows; a batch that was written twice counts once."""
        schema = "blob string, rule string, start bigint, `end` bigint, mark boolean"
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def update(self, documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the pairs of blob and rule version that are not in the ledger yet."""
        labels = F.array(*(F.lit(r.label) for r in rules))
        text = F.coalesce("text", F.lit(""))
        blobs = documents.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
        seen = self.rows().where("mark").groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = F.array_except(labels, F.coalesce("seen", F.array().cast("array<string>")))
        unseen = blobs.join(seen, "blob", "left").withColumn("todo", todo).where(F.size("todo") > 0)
        _scan(unseen, rules).write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, kind, n, start, end): n is the place of the rule in ``rules``."""
        number = F.array_position(F.array(*(F.lit(r.label) for r in rules)), F.col("rule")) - 1  # -1: not one of these
        kind = F.regexp_extract("rule", "^(.*)@", 1)
        return self.rows().where("start is not null").select("blob", kind.alias("kind"), number.alias("n"), "start", "end").where("n >= 0").distinct()


def scan(documents: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row's doc_id, counts of the base kinds, digest of the base spans, and all spans."""
    ledger.update(documents, rules)
    base = len(BASE)
    span = F.concat_ws(":", "kind", "start", "end")
    own = ledger.findings(rules).groupBy("blob").agg(
        *(F.count_if(F.col("n") == i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)),
        F.sort_array(F.collect_list(F.struct("start", "n", span.alias("span")))).alias("all"),
    )
    joined = documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob")).join(own, "blob", "left")
    listed = F.coalesce(F.array_join("all.span", ","), F.lit(""))
    listed_base = F.coalesce(F.array_join(F.transform(F.filter("all", lambda x: x["n"] < base), lambda x: x["span"]), ","), F.lit(""))
    return joined.select(
        "doc_id",
        *(F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in BASE),
        F.sha2(listed_base, 256).alias("base_sha256"),
        listed.alias("spans"),
    )
