"""Native word columns, and keys that tell rows apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# ASCII letters and digits, and anything beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """doc_id, a hash ``h`` of the text and the text: rows of equal id and text share their results."""
    return df.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce("text", F.lit("")).alias("text"), *columns)


def by_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, h), null ids included; ``right`` has one row for a key."""
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "h": "_h"})
    on = left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["h"] == right["_h"])
    joined = left.join(right, on, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop("_doc_id", "_h")


def grams(df: DataFrame, size: int, words: str = "words", position: str = "pos") -> DataFrame:
    """One row for each place of ``size`` consecutive words: the other columns, ``pos``, w0, w1, ..."""
    keep = [c for c in df.columns if c != words]
    names = [f"w{i}" for i in range(size)]
    shifted = [F.slice(words, i + 1, F.greatest(F.size(words), F.lit(1))).alias(n) for i, n in enumerate(names)]
    rows = df.where(F.size(words) >= size).select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias(position, "g"))
    return rows.where(F.col(f"g.{names[-1]}").isNotNull()).select(*keep, position, *(F.col(f"g.{n}").alias(n) for n in names))
