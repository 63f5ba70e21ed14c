"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``size`` words. A window occurs in a document
only if all its word shingles do, so one of them is its necessary prefix: the
rarest, by a sketch of the word counts of all documents (a shingle is at most as
frequent as its rarest word). Texts are split into words once, and what looks at
all of them reads their hashes from a table. Only prefixes are joined with the documents, one
row a window. Their places, shifted to the window's start and bounded by the
document's length, are the candidates; each is verified against the document's
own words, of which only those of documents with a candidate travel, in chunks.

Edge cases: null text has no words and no windows; rows of equal id and text
share one result; repeated items count once by their id; an empty table of
items leaves every document clean; other columns are kept out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, join_small
from .words import by_key, keyed, words_of

SHINGLE = 4
CELLS = 1 << 18  # counters of the sketch of word counts, whatever the size of the documents
CHUNK = 512  # words of a document that meet its candidates in one row
BROADCAST_ROWS = 200_000  # windows or keys of documents that may be broadcast
SALTS = 32  # tasks among which the places of one prefix are dealt beyond that


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(window, item_id): distinct windows as arrays of words, with the items that have them."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1)))
    return words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window")).distinct()


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, hashes) of ``docs(doc_id, h, words)``: a hash for each word, as a table, so that texts are split once."""
    return cut(docs.select("doc_id", "h", _hashes(F.col("words")).alias("hashes")), "words")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _gram(hashes: Column, at: Column, size: int) -> Column:
    """A hash of the run of ``size`` words from 0-based ``at`` on."""
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(size)))


def _grams(hashes: DataFrame, size: int) -> DataFrame:
    """(doc_id, h, n_words, pos, g): the runs of ``size`` words of ``hashes(doc_id, h, hashes)``, one at every position that has one."""
    rows = hashes.select("doc_id", "h", "hashes", F.size("hashes").alias("n_words"), F.posexplode("hashes").alias("pos", "first"))
    return rows.where(F.col("pos") + size <= F.col("n_words")).select("doc_id", "h", "n_words", "pos", _gram(F.col("hashes"), F.col("pos"), size).alias("g"))


def _cell(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(CELLS))


def prefixes(windows: DataFrame, docs: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """(wid, window, len, s, at, g) of ``windows(wid, window, len)``: place, length and hash of each one's rarest shingle in ``docs(words)`` or their ``hashes``."""
    hashes = docs.select(_hashes(F.col("words")).alias("hashes")) if hashes is None else hashes
    cells = hashes.select(F.explode("hashes").alias("hash")).select(F.pmod("hash", F.lit(CELLS)).alias("cell"))
    sketch = cut(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "rarity")
    words = windows.select("wid", F.posexplode("window").alias("i", "word")).withColumn("cell", _cell(F.col("word")))
    words = words.join(F.broadcast(sketch), "cell", "left")  # CELLS rows at most
    counts = words.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("n", F.lit(0)).alias("n")))).alias("c"))
    s = F.least("len", F.lit(SHINGLE))

    def rank(at: Column) -> Column:
        own = F.slice("c.n", at + 1, s)
        return F.struct(F.array_min(own).alias("rarest"), F.aggregate(own, F.lit(0).cast("long"), lambda x, y: x + y).alias("total"), at.alias("at"))

    first = F.array_min(F.transform(F.sequence(F.lit(0), F.col("len") - s), rank))
    found = windows.join(counts, "wid").select("wid", "window", "len", s.alias("s"), first["at"].alias("at"))
    own = _hashes(F.col("window"))
    gram = F.when(F.col("s") == SHINGLE, _gram(own, F.col("at"), SHINGLE))
    for size in range(1, SHINGLE):
        gram = gram.when(F.col("s") == size, _gram(own, F.col("at"), size))
    return found.withColumn("g", gram)


def _at_prefixes(places: DataFrame, prefix: DataFrame, rows: int) -> DataFrame:
    """``places`` joined with ``prefix`` on g; beyond the broadcast, the places of one prefix are dealt to SALTS tasks."""
    if rows <= BROADCAST_ROWS:
        return places.join(F.broadcast(prefix), "g")
    places = places.withColumn("salt", F.pmod("pos", F.lit(SALTS)))
    return places.join(prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"]).drop("salt")


def occurrences(docs: DataFrame, items: DataFrame, size: int = 10, hashes: DataFrame | None = None) -> DataFrame:
    """(doc_id, h, start, len, item_id) for every place of a window in ``docs(doc_id, h, words)``, of which ``hashes`` are :func:`hashed`."""
    found = windows_of(items, size)
    windows = cut(
        found.groupBy("window").agg(F.collect_set("item_id").alias("items")).withColumn("wid", F.monotonically_increasing_id()), "windows"
    ).withColumn("len", F.size("window"))
    n_windows = windows.count()
    sizes = sorted(r[0] for r in windows.select(F.least("len", F.lit(SHINGLE)).alias("s")).distinct().collect())  # at most SHINGLE numbers
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, h bigint, start int, len int, item_id string")

    hashes = hashed(docs) if hashes is None else hashes
    prefix = cut(prefixes(windows.drop("items"), docs, hashes), "prefixes")
    candidates = []
    for s in sizes:
        candidates.append(_at_prefixes(_grams(hashes, s), prefix.where(F.col("s") == s).drop("s"), n_windows))
    start = F.col("pos") - F.col("at")
    candidates = reduce(DataFrame.unionByName, candidates).where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    candidates = cut(candidates.select("doc_id", "h", start.alias("start"), "len", "wid", "window"), "candidates")

    # verified word by word: the chunks of documents that have a candidate, each reaching a window into the next
    keys = cut(candidates.select("doc_id", "h").distinct(), "keys")
    own = by_key(docs, F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "left_semi")
    firsts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(CHUNK))
    chunks = own.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.posexplode(F.transform(firsts, lambda i: F.slice("words", i + 1, CHUNK + size))).alias("_c", "chunk"))
    here = F.col("start") % CHUNK
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")) & (F.floor(F.col("start") / CHUNK) == F.col("_c"))
    exact = candidates.join(chunks, same & (F.slice("chunk", here + 1, F.col("len")) == F.col("window")), "left_semi").select("doc_id", "h", "start", "len", "wid").distinct()
    return join_small(exact, windows.select("wid", "items"), "wid", "inner", n_windows).select(
        "doc_id", "h", "start", "len", F.explode("items").alias("item_id")
    )


def scan(documents: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``documents``."""
    docs = keyed(documents).withColumn("words", words_of(F.col("text"))).drop("text")
    hashes = hashed(docs)
    places = cut(occurrences(docs, items, size, hashes), "occurrences")
    spans = places.select("doc_id", "h", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = Window.partitionBy("doc_id", "h").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = spans.withColumn("new", F.greatest(F.col("end") - reach, F.lit(0))).groupBy("doc_id", "h").agg(F.sum("new").alias("n_hit"))
    own = places.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    both = by_key(hit, own, "inner")
    return by_key(hashes.select("doc_id", "h", F.size("hashes").cast("long").alias("n_words")), both).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``documents`` that have no window of an item, with their columns."""
    docs = keyed(documents, F.struct(*documents.columns).alias("row"))
    found = cut(occurrences(docs.select("doc_id", "h", words_of(F.col("text")).alias("words")), items, size).select("doc_id", "h").distinct(), "contaminated")
    return by_key(docs.drop("text"), found.withColumn("hit", F.lit(True))).where("hit is null").select("row.*")
