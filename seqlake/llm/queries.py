"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, decontamination, html, jaccard, licenses, lines, media, negatives, packing, quality, secrets, toxicity
from .common import shared_dir, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WINDOW_VOCABULARY = "byte_bpe_50k.json"


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "media")
    media.store(table(spark, sf_dir, "documents"), folder)
    return media.features(media.load(spark, folder))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.Ledger(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), public_tokenizers.path(WINDOW_VOCABULARY), public_tokenizers.PATTERN)


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_bpe_encoding,
        op3_line_dedup,
        op4_ngram_jaccard_join,
        op5_toxicity,
        op6_license_scans,
        op7_html_extraction,
        op8_benchmark_decontamination,
        op9_media_columns,
        op10_secret_scans,
        op11_hard_negatives,
        op12_packing,
        op13_filter_interaction_audit,
    )
}

ORACLES: dict[str, str] = {}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# every word with the nine after it, against every window of an item
ORACLES["op8_benchmark_decontamination"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, w[k : k + 9] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
words AS (SELECT r, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM docs),
ahead AS (SELECT r, k, list(word) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM words),
places AS (SELECT a.r, a.k, s.n, x.item_id FROM ahead a JOIN sizes s ON len(a.l) >= s.n JOIN windows x ON x.win = a.l[1 : s.n]),
hits AS (SELECT r, count(DISTINCT k + o) AS n_hit FROM (SELECT r, k, unnest(range(0, n)) AS o FROM places) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM places) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN found USING (r)"""


def _spans(nth: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Spans of a kind: lengths of what is between matches and of matches, summed along the text."""
    pattern = pattern.replace("'", "''")
    return rf"""SELECT r, {nth} AS nth, '{kind}' AS kind, stop - m AS start, stop FROM (
        SELECT *, CAST(sum(g + m) OVER (PARTITION BY r ORDER BY k) AS BIGINT) AS stop FROM (
          SELECT r, generate_subscripts(matches, 1) AS k, unnest(list_transform(gaps[1 : len(matches)], lambda x: length(x))) AS g,
            unnest(list_transform(matches, lambda x: length(x))) AS m, unnest(list_transform(tested, lambda x: length(x))) AS v
          FROM (SELECT r, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS matches,
            regexp_extract_all(t, '{pattern}', {group}) AS tested FROM docs))) WHERE v >= {least}"""


KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("forge_token", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
)

ORACLES["op10_secret_scans"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans(n, *k) for n, k in enumerate(KINDS))}),
named AS (SELECT r, nth, start, concat_ws(':', kind, start, stop) AS span FROM spans),
own AS (SELECT r, count(*) FILTER (WHERE nth = 0) AS n_assign, count(*) FILTER (WHERE nth = 1) AS n_access, count(*) FILTER (WHERE nth = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, nth) FILTER (WHERE nth < 3) AS base, string_agg(span, ',' ORDER BY start, nth) AS spans FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN own USING (r)"""

# equal sets once; pairs by their shingles; the least id that links reach
ORACLES["op4_ngram_jaccard_join"] = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT r, len(w) AS n, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM docs),
runs AS (SELECT r, n, list(word) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS l, k FROM words),
shingles AS (SELECT DISTINCT r, array_to_string(l, ' ') AS s FROM runs WHERE k <= greatest(n - 4, 1)),
sets AS (SELECT r, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS f FROM shingles GROUP BY r),
classes AS (SELECT f, min(r) AS r, any_value(n) AS n, min(doc_id) AS least FROM sets JOIN docs USING (r) GROUP BY f),
entries AS (SELECT c.r, c.n, s FROM classes c JOIN shingles USING (r)),
links AS (SELECT a.r AS a, b.r AS b FROM entries a JOIN entries b ON a.s = b.s AND a.r < b.r AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT r AS x, r AS y FROM classes UNION SELECT x, b FROM reached JOIN both_ways ON a = y),
roots AS (SELECT x, min(least) AS component_id FROM reached JOIN classes ON classes.r = y GROUP BY x)
SELECT doc_id, coalesce(s.n, 0) AS n_shingles, CASE WHEN s.n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM docs LEFT JOIN sets s USING (r) LEFT JOIN classes USING (f) LEFT JOIN roots ON roots.x = classes.r"""


# the first failing filter of each mask in each order
ORACLES["op13_filter_interaction_audit"] = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
least AS (SELECT t, min(doc_id) AS m FROM docs GROUP BY t),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failed AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END ||
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END ||
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > m THEN 'E' ELSE '' END AS fails
  FROM docs JOIN least USING (t) LEFT JOIN marks USING (doc_id)),
masks AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE b.f <> a.f AND c.f NOT IN (a.f, b.f) AND d.f NOT IN (a.f, b.f, c.f) AND e.f NOT IN (a.f, b.f, c.f, d.f)),
steps AS (SELECT o, s, substr(o, s, 1) AS f FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS s)),
met AS (SELECT part, o, fails, n, good, toxic, list_min(list_transform(string_split(fails, ''), lambda x: instr(o, x))) AS hit
    FROM masks, orders WHERE fails <> '' UNION ALL SELECT part, o, fails, n, good, toxic, 6 FROM masks, orders WHERE fails = ''),
counted AS (SELECT part, o, s, f,
    sum(CASE WHEN hit > s THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit = s THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit < s AND contains(fails, f) THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit = s THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM met JOIN steps USING (o) GROUP BY ALL)
SELECT part, o AS filter_order, s AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""

ORACLES["op11_hard_negatives"] = """
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank
    FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""
