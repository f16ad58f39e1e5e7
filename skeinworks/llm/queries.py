"""The registered queries of this subpackage: thin calls of its operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skeinworks.llm import best_fit_packing, cotraining, importance, language_id, personal_data, ranked_search, secret_scan, simhash, substring_dedup, syncmers, token_rollup, toxicity, wu_manber
from skeinworks.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), language_id.held_out(5, 0)
    found = language_id.identify(docs, language_id.train(docs, ~held), ["doc_id", "text"])
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), language_id.held_out(3, 1)
    model = cotraining.train(docs, table(spark, sf_dir, "labels"), ~held)
    return cotraining.score(docs, model).select("doc_id", held.alias("held_out"), "content_score", "metadata_score", "score", "predicted")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), language_id.held_out(3, 1)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.rollup_documents(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scan(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: Words of op1 and op7, windows as joined words; both hold whole tables.
_OP1 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, r, i, array_to_string(ws[i : i + 19], ' ') AS win FROM d, unnest(range(1, len(ws) - 18)) AS t(i)),
f AS (SELECT doc_id, r, i, rank() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM w),
c AS (SELECT DISTINCT r, i + k AS p FROM f, unnest(range(0, 20)) AS t(k) WHERE nth > 1),
l AS (SELECT r, p, ws[p] AS word FROM d, unnest(range(1, len(ws) + 1)) AS t(p)),
k AS (SELECT l.r, count(*) AS n, string_agg(word, ' ' ORDER BY l.p) AS kept FROM l ANTI JOIN c ON l.r = c.r AND l.p = c.p GROUP BY l.r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""
_OP7 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
m AS (SELECT item_id, ws, least(13, len(ws)) AS m FROM b WHERE len(ws) > 0),
x AS (SELECT DISTINCT item_id, m, array_to_string(ws[i : i + m - 1], ' ') AS win FROM m, unnest(range(1, len(ws) - m + 2)) AS t(i)),
w AS (SELECT r, i, s.m, array_to_string(ws[i : i + s.m - 1], ' ') AS win FROM d, (SELECT DISTINCT m FROM x) AS s, unnest(range(1, len(ws) - s.m + 2)) AS t(i)),
h AS (SELECT w.r, w.i, w.m, x.item_id FROM w JOIN x ON w.m = x.m AND w.win = x.win),
p AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(0, m)) AS t(k) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), FALSE) AS contaminated
FROM d LEFT JOIN p ON d.r = p.r LEFT JOIN n ON d.r = n.r
"""
#: Checksums by the polynomial's table, a byte a step.
_OP12 = r"""
WITH z AS (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS tab FROM range(256) AS t(b)),
x AS (SELECT 0 AS side, doc_id, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, item_id, -row_number() OVER (), text FROM benchmark),
d AS (SELECT side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM x),
g AS (SELECT side, r, array_to_string(ws[i : i + n - 1], ' ') AS f FROM d, unnest([1, 2, 3]) AS a(n), unnest(range(1, len(ws) - n + 2)) AS t(i)),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM g)),
b AS (SELECT f, list_reduce(list_transform(range(0, len(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT), lambda c, o: xor(c >> 8, tab[(xor(c, o) & 255) + 1]), 4294967295) AS c FROM u, z),
k AS (SELECT f, xor(c, 4294967295) % 10000 AS bucket FROM b),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM g JOIN k USING (f) GROUP BY bucket),
v AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000))))::BIGINT AS gain FROM n),
w AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM g JOIN k USING (f) JOIN v USING (bucket) WHERE side = 0 GROUP BY r),
e AS (SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || sha256('42:' || doc_id)[1:8])::BIGINT AS h FROM d LEFT JOIN w USING (r) WHERE side = 0),
s AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM e),
o AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS p FROM s)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN p <= (SELECT 5 * count(*) // 100 FROM s WHERE n_words >= 20) THEN p END AS rank, CAST(n_words AS BIGINT) AS n_words FROM o
"""
_OP13 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
l AS (SELECT doc_id, r, len(ws) AS n FROM d WHERE len(ws) > 0),
a AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM l),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), a),
m AS (SELECT doc_id, r, 10 + (90 * n * n_docs) // n_terms AS m FROM l, a),
s AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """SQL has no fingerprints, models or tokenizers for the others; tests hold these against brute force."""
    return {"op1_substring_dedup": _OP1, "op7_benchmark_decontamination": _OP7, "op12_importance_resampling": _OP12, "op13_ranked_search": _OP13}
