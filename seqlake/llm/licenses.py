"""License scans by diagonal voting.

Templates are the sections of whole licenses, the notices by which works name a
license, and identifiers with their versions. All rolling word k-grams of a
document are joined to the k-grams of the templates. A match votes for the
diagonal (place in the document less place in the template); votes of neighbouring
diagonals are merged, so that a word more or less does not split a hit. A hit whose
diagonals have enough of the template's k-grams, in a span of bounded length, is
verified on the document's own words: along its diagonals, in the order of the
template, enough of the template's words must stand there. Of hits whose spans
overlap, only the best one stays, so that of similar notices one gives its label.
Beside these, phrases name licenses outright.

Edge cases: null text has no words; rows of equal id and text share one result;
an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import license_texts
from .common import cut
from .words import WORD, by_key, grams, keyed, words_of

K = 3
SLACK = 2  # diagonals this near are one hit
COVERAGE = 0.6  # of a template's k-grams, and of its words in order, for a verified hit
STRETCH = 1.5  # words of a verified hit at most, to those of its template
BROADCAST_ROWS = 200_000  # keys of documents with a hit that may be broadcast

# Phrases of the base labels.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
LICENSES = [(label, name, re.findall(WORD, text.lower())) for label, name, text in license_texts.templates()]
TEMPLATES = [(label, " ".join(words)) for label, _, words in LICENSES]


def templates(spark: SparkSession) -> DataFrame:
    """(template, total, at, g, t0, t1, t2): the k-grams of the fixed templates."""
    rows = []
    for number, (_, _, words) in enumerate(LICENSES):
        rows += [(number, len(words) - K + 1, at, *words[at : at + K]) for at in range(len(words) - K + 1)]
    names = [f"t{i}" for i in range(K)]
    schema = "template int, total int, at int, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).withColumn("g", F.xxhash64(*names))


def _in_order(words: Column, wanted: Column, diagonals: Column) -> Column:
    """How many of the ``wanted`` words stand in ``words`` on one of the diagonals, each after the one before."""

    def step(state: Column, i: Column) -> Column:
        here = F.array_min(F.filter(F.transform(diagonals, lambda d: d + i), lambda p: (p > state["last"]) & (F.get(words, p) == F.get(wanted, i))))
        return F.struct(F.coalesce(here, state["last"]).alias("last"), (state["n"] + F.when(here.isNotNull(), 1).otherwise(0)).alias("n"))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(F.sequence(F.lit(0), F.size(wanted) - 1), start, step, lambda state: state["n"])


def candidates(documents: DataFrame) -> DataFrame:
    """(doc_id, h, template, start, end, diagonals): merged diagonals with enough k-grams of ``documents(doc_id, h, words)``."""
    names = [f"w{i}" for i in range(K)]
    places = grams(documents.select("doc_id", "h", "words"), K).withColumn("g", F.xxhash64(*names))
    same = [F.col("g") == F.col("tg")] + [F.col(f"w{i}") == F.col(f"t{i}") for i in range(K)]
    known = templates(documents.sparkSession).withColumnRenamed("g", "tg")
    votes = places.join(F.broadcast(known), same)  # some thousand rows, fixed
    votes = votes.select("doc_id", "h", "template", "total", "at", "pos", (F.col("pos") - F.col("at")).alias("diagonal"))
    diagonals = votes.groupBy("doc_id", "h", "template", "total", "diagonal").agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("start"), (F.max("pos") + K).alias("end")
    )
    along = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > SLACK, F.lit(True)).cast("int")
    covered = F.size(F.array_distinct(F.flatten(F.collect_list("ats"))))
    merged = (
        diagonals.withColumn("fresh", fresh)
        .withColumn("hit", F.sum("fresh").over(along))
        .groupBy("doc_id", "h", "template", "total", "hit")
        .agg(covered.alias("covered"), F.min("start").alias("start"), F.max("end").alias("end"), F.sort_array(F.collect_set("diagonal")).alias("diagonals"))
    )
    enough = (F.col("covered") >= COVERAGE * F.col("total")) & (F.col("end") - F.col("start") <= STRETCH * (F.col("total") + K - 1))
    return merged.where(enough).select("doc_id", "h", "template", "start", "end", "diagonals")


def hits(documents: DataFrame) -> DataFrame:
    """Verified hits: (doc_id, h, label, license, start, end, coverage) of ``documents(doc_id, h, text)``."""
    spark = documents.sparkSession
    found = cut(candidates(documents.select("doc_id", "h", words_of(F.col("text")).alias("words"))), "hits")
    texts = spark.createDataFrame(list(enumerate(x[2] for x in LICENSES)), "template int, wanted array<string>")
    found = found.join(F.broadcast(texts), "template")  # fixed
    fields = ("template", "start", "end", "diagonals", "wanted")
    own = found.groupBy("doc_id", "h").agg(F.collect_list(F.struct(*fields)).alias("hits"))
    keys = found.select("doc_id", "h").distinct()
    # only documents with a hit travel, each once with all its hits
    docs = by_key(documents.select("doc_id", "h", "text"), F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "left_semi")
    docs = by_key(docs.select("doc_id", "h", words_of(F.col("text")).alias("words")), own, "inner")

    def compared(x: Column) -> Column:
        return F.struct(x["template"].alias("template"), x["start"].alias("start"), x["end"].alias("end"), F.size(x["wanted"]).alias("n"), _in_order(F.col("words"), x["wanted"], x["diagonals"]).alias("matched"))

    rows = docs.select("doc_id", "h", F.inline(F.transform("hits", compared))).withColumn("coverage", F.col("matched") / F.col("n")).where(F.col("coverage") >= COVERAGE)
    # spans that overlap, directly or through others, are one notice: its best hit stays
    by_start = Window.partitionBy("doc_id", "h").orderBy("start", "end", "template")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    notices = rows.withColumn("apart", apart).withColumn("notice", F.sum("apart").over(by_start))
    best = F.max_by(F.struct("template", "start", "end", "coverage"), F.struct("coverage", "matched", -F.col("template"))).alias("b")
    named = spark.createDataFrame([(i, x[0], x[1]) for i, x in enumerate(LICENSES)], "template int, label string, license string")
    best = notices.groupBy("doc_id", "h", "notice").agg(best).select("doc_id", "h", "b.*").join(F.broadcast(named), "template")
    return best.select("doc_id", "h", "label", "license", "start", "end", "coverage")


def base_places(words: str = "words"):
    """Array of (start, label) where the words of a phrase stand consecutively."""
    w = F.col(words)

    def at(word, i):
        tests = None
        for label, phrase in PHRASES.items():
            back = len(phrase) - 1
            test = i >= back
            for j in range(back):
                test = test & (F.get(w, i - back + j) == phrase[j])
            place = F.struct((i - back).cast("long").alias("start"), F.lit(label).alias("label"))
            tests = F.when(test, place) if tests is None else tests.when(test, place)
        return F.when(word == "license", tests)

    places = F.filter(F.transform(w, at), lambda x: x.isNotNull())
    return F.when(F.array_contains(w, "license"), places)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, licenses of every row.

    ``licenses`` names the licenses of the method's hits with their versions.
    """
    texts = keyed(documents)
    docs = texts.withColumn("words", words_of(F.col("text"))).drop("text")
    plain = docs.select("doc_id", "h", F.size("words").cast("long").alias("n_words"), base_places().alias("base"))
    found = hits(texts).groupBy("doc_id", "h").agg(
        F.collect_set("label").alias("found"), F.array_sort(F.collect_set("license")).alias("licenses"), F.max("coverage").alias("coverage")
    )
    base_labels = F.coalesce(F.array_sort(F.array_distinct("base.label")), F.array().cast("array<string>"))
    every = F.array_sort(F.array_union(base_labels, F.coalesce("found", F.array().cast("array<string>"))))
    return by_key(plain, found).select(
        "doc_id",
        "n_words",
        F.when(F.col("base").isNull(), 0).otherwise(F.size("base")).cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("coverage", F.lit(0.0)), F.when(F.size(base_labels) > 0, 0.5).otherwise(0.0)).alias("score"),
        F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("licenses"),
    )
