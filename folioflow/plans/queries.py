"""The named queries over the test tables, each with the SQL that another engine runs for comparison.

A query is portable SQL with {tables} in braces, or a function of the library beside SQL of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import control, documents, intervals, retrieval, tables
from ..sources.tables import table
from ..streaming import windows as streams
from . import facts, library, mechanisms, records, reports, services
from .fixtures import HEADINGS, KEYS, NEW, OLD, POINTS, REGIONS, RUN_A, RUN_B, SCORES, STATUS, duck, values

VERDICT = """CASE WHEN truth IS NULL THEN 'unresolvable' WHEN abstained OR val IS NULL THEN 'abstained' WHEN val = truth THEN 'exact'
 WHEN truth <> 0 AND abs(val - truth) / abs(truth) <= 0.005 THEN 'within_tolerance'
 WHEN truth <> 0 AND val <> 0 AND (abs(val * 1e3 - truth) / abs(truth) <= 0.005 OR abs(val / 1e3 - truth) / abs(truth) <= 0.005 OR abs(val * 1e6 - truth) / abs(truth) <= 0.005 OR abs(val / 1e6 - truth) / abs(truth) <= 0.005 OR abs(val * 1e9 - truth) / abs(truth) <= 0.005 OR abs(val / 1e9 - truth) / abs(truth) <= 0.005) THEN 'scale_error' WHEN truth = 0 OR val = 0 OR greatest(abs(val), abs(truth)) / least(abs(val), abs(truth)) > 10 THEN 'hallucinated' ELSE 'wrong' END"""

#: SQL of one text for both engines; library.py holds library code for some of them, which this text then checks.
PORTABLE = {
    "filter_metadata": "SELECT doc_id, source, lang, n_chars FROM {documents} WHERE source = 'src3' AND upper(lang) = 'EN' AND n_chars >= 500",
    "filter_in_list": "SELECT doc_id, lang FROM {documents} WHERE lang IN ('de', 'fr') AND source IN ('src1', 'src2')",
    "filter_year_range": "SELECT o_orderkey, o_totalprice FROM {orders} WHERE year(o_orderdate) BETWEEN 1995 AND 1996 AND o_totalprice > 200000",
    "filter_like_prefix": "SELECT p_partkey, p_type FROM {part} WHERE upper(p_type) LIKE 'PROMO%'",
    "filter_null": "SELECT count(*) AS n, count(text) AS with_text FROM {documents} WHERE text IS NOT NULL",
    "join_left_semi": "SELECT o_orderkey FROM {orders} WHERE EXISTS (SELECT 1 FROM {customer} WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')",
    "join_left_default": "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id",
    "join_override_coalesce": "SELECT n.n_nationkey, coalesce(o.name, n.n_name) AS name FROM {nation} n LEFT JOIN (VALUES (1, 'override one'), (3, 'override three')) AS o(k, name) ON o.k = n.n_nationkey",
    "incremental_pending": f"SELECT n.id, n.digest FROM {NEW} LEFT JOIN {OLD} ON o.id = n.id WHERE o.digest IS NULL OR o.digest <> n.digest",
    "prune_anti_join": f"SELECT o.id FROM {OLD} LEFT JOIN {NEW} ON o.id = n.id WHERE n.id IS NULL",
    "store_stats": "SELECT count(*) AS n, count(text) AS n_text, count(DISTINCT source) AS n_sources, max(n_chars) AS longest FROM {documents}",
    "indexed_filings": "SELECT source, max(lang) AS lang, max(n_chars) AS longest, count(*) AS n FROM {documents} GROUP BY source ORDER BY longest DESC, source",
    "verdict_rows": f"SELECT accession, field, {VERDICT} AS verdict FROM {SCORES}",
    "field_rates": f"SELECT field, count(*) AS total, sum(CASE WHEN v IN ('exact','within_tolerance') THEN 1 ELSE 0 END) * 1.0E0 / count(*) AS accuracy, sum(CASE WHEN v = 'abstained' THEN 1 ELSE 0 END) * 1.0E0 / count(*) AS abstention FROM (SELECT field, {VERDICT} AS v FROM {SCORES}) x GROUP BY field",
    "scorecard_accuracy": f"SELECT accession, round(avg(CASE WHEN v IN ('exact','within_tolerance') THEN 1.0E0 ELSE 0.0E0 END), 4) AS accuracy FROM (SELECT accession, {VERDICT} AS v FROM {SCORES}) x WHERE v <> 'unresolvable' GROUP BY accession",
    "failure_taxonomy": f"SELECT v AS verdict, count(*) AS n FROM (SELECT {VERDICT} AS v FROM {SCORES}) x WHERE v NOT IN ('exact','within_tolerance') GROUP BY v",
    "quality_gate": f"SELECT m AS measured, 0.6E0 AS floor, m >= 0.6E0 AS passed FROM (SELECT avg(CASE WHEN v IN ('exact','within_tolerance') THEN 1.0E0 ELSE 0.0E0 END) AS m FROM (SELECT {VERDICT} AS v FROM {SCORES}) x WHERE v <> 'unresolvable') y",
    "item_monotonic": f"SELECT doc, part, pos, num FROM (SELECT h.*, max(num) OVER (PARTITION BY doc, part ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {HEADINGS}) x WHERE m IS NULL OR num > m",
    "lead_region_end": f"SELECT doc, pos, lead(pos, 1, 100) OVER (PARTITION BY doc ORDER BY pos) AS region_end FROM {HEADINGS}",
    "block_offsets": "SELECT doc_id, source, coalesce(CAST(sum(n_chars + 2) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start_at FROM {documents}",
    "chunk_ordinals": "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS ordinal FROM {conversations}",
    "rank_within_query": "SELECT o_custkey, o_orderkey, rk FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM {orders}) x WHERE rk <= 3",
    "scorecard_latest": "SELECT event_id, user_id FROM {events} ORDER BY ts DESC, event_id DESC LIMIT 50",
    "rrf_terms": f"SELECT id, round(sum(s), 9) AS score, count(*) AS n_runs FROM (SELECT id, 1.0E0 / (60 + rank) AS s FROM {RUN_A} UNION ALL SELECT id, 1.0E0 / (60 + rank) AS s FROM {RUN_B}) x GROUP BY id",
    "setop_union_distinct": "SELECT source FROM {documents} WHERE lang = 'de' UNION SELECT source FROM {documents} WHERE lang = 'fr'",
    "setop_intersect": f"SELECT id FROM {RUN_A} INTERSECT SELECT id FROM {RUN_B}",
    "setop_except": f"SELECT id FROM {RUN_A} EXCEPT SELECT id FROM {RUN_B}",
    "distinct_sorted": "SELECT DISTINCT source FROM {documents} ORDER BY source",
    "metric_counter": "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM {events} GROUP BY event_type",
    "metric_gauge_last": "SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) x WHERE rn = 1",
    "retrieval_metrics": f"SELECT avg(p) AS precision_at_4, avg(r) AS recall_at_4, avg(mrr) AS mrr FROM (SELECT sum(rel) / 4.0E0 AS p, max(rel) * 1.0E0 AS r, coalesce(max(CASE WHEN rel = 1 THEN 1.0E0 / rank END), 0.0E0) AS mrr FROM (SELECT id, rank, CASE WHEN id % 100 = 2 THEN 1 ELSE 0 END AS rel FROM {RUN_A}) x) y",
    "http_status_class": f"SELECT event_id, code, CASE WHEN code IN (429, 500, 502, 503, 504) THEN 'retry' WHEN code IN (403, 404) THEN 'empty' WHEN code >= 400 THEN 'fail' ELSE 'ok' END AS class FROM {STATUS}",
    "cache_stats": f"SELECT count(*) AS lookups, count(o.id) AS hits, count(o.id) * 1.0E0 / count(*) AS hit_rate FROM {NEW} LEFT JOIN {OLD} ON o.id = n.id AND o.digest = n.digest",
    "revenue_by_region": "SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY r_name, n_name",
}


def _portable(sql: str):
    return lambda spark, folder: values(spark, folder, f"({sql}) q")


def pad_cik(spark, folder):
    return values(spark, folder, KEYS).select("k", "raw", T.padded_id(F.col("raw")).alias("cik"))


def token_count(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.token_count(F.col("text")).alias("tokens"))


def token_estimates(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.floor(F.char_length("text") / 2.5).cast("int").alias("by_chars"), F.floor(F.char_length("text") / 4).cast("int").alias("by_four"))


def normalise_whitespace(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.normalised_space(F.col("text")), 256).alias("digest"))


def verify_hashes(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"), F.octet_length("html").cast("bigint").alias("n_bytes"))


def scan_json_props(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def score_fields(spark, folder):
    return values(spark, folder, SCORES).select("accession", "field", T.verdict(F.col("val").cast("double"), F.col("truth").cast("double"), F.col("abstained")).alias("verdict"))


def upsert_merge(spark, folder):
    return tables.upserted(values(spark, folder, OLD), values(spark, folder, NEW), "id", ["company"])


def interval_point_join(spark, folder):
    return intervals.containing(values(spark, folder, POINTS), values(spark, folder, REGIONS), "doc")


def fts(**how):
    def run(spark, folder):
        rows = retrieval.with_tokens(table(spark, folder, "documents"))
        return rows.filter(retrieval.matches(F.col("tokens"), **how)).select("doc_id")

    return run


_TOKENS = "(SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS tokens FROM documents) d"
_NO_TERMS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


def bm25_topk(spark, folder):
    return retrieval.bm25(table(spark, folder, "documents"), "doc_id", ["the", "license", "licensed"], 20).select("doc_id", F.round("score", 6).alias("score"))


_BM25 = f"""WITH t AS (SELECT doc_id, {_NO_TERMS} AS w FROM documents), c AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'license')) AS b, len(list_filter(w, lambda x: x = 'licensed')) AS c FROM t),
s AS (SELECT count(*) AS n, avg(dl) AS av, sum((a > 0)::INT) AS fa, sum((b > 0)::INT) AS fb, sum((c > 0)::INT) AS fc FROM c),
x AS (SELECT doc_id, ln(1 + (n - fa + 0.5) / (fa + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / av)) + ln(1 + (n - fb + 0.5) / (fb + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / av)) + ln(1 + (n - fc + 0.5) / (fc + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * dl / av)) AS score FROM c, s WHERE a + b + c > 0)
SELECT doc_id, round(score, 6) AS score FROM x ORDER BY round(score, 9) DESC, doc_id LIMIT 20"""


def dense_topk_batch(spark, folder):
    v = table(spark, folder, "embeddings")
    queries = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return retrieval.dense_topk(queries, v, 5).select("query_id", "vec_id", "rank")


def hybrid_rrf(spark, folder):
    return retrieval.rrf([values(spark, folder, RUN_A), values(spark, folder, RUN_B)], "id", top=4)


def session_counts(spark, folder):
    e = table(spark, folder, "events").withColumn("s", F.unix_seconds(F.col("ts").cast("timestamp")))
    return intervals.sessions(e, "user_id", "s", 86400).select("user_id", F.col("session").cast("bigint").alias("session"), "n")


def chunk_windows(spark, folder):
    return documents.chunked(table(spark, folder, "documents"))


def html_flat_text(spark, folder):
    return documents.flattened(table(spark, folder, "pages"))


def token_bucket_waits(spark, folder):
    e = table(spark, folder, "events").select(F.col("event_type").alias("key"), (F.unix_seconds(F.col("ts").cast("timestamp")) / 3600.0).alias("t"), F.lit(1.0).alias("n"))
    return control.token_bucket_waits(e, 1.0)


def breaker_states(spark, folder):
    e = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("key"), F.unix_seconds(F.col("ts").cast("timestamp")).cast("double").alias("t"), (F.col("event_type") != "error").alias("ok"))
    return control.breaker_states(e, 2, 86400.0)


#: Functions of the library, with the SQL to compare with (None: tested in tests/ instead).
OWN = {
    "pad_cik": (pad_cik, f"SELECT k, raw, lpad(coalesce(nullif(ltrim(regexp_replace(trim(raw), '^CIK', ''), '0'), ''), '0'), 10, '0') AS cik FROM {KEYS}"),
    "token_count": (token_count, "SELECT doc_id, CAST(CASE WHEN n > 0 THEN floor(n / 0.75) + 1 ELSE 0 END AS INTEGER) AS tokens FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents) x"),
    "token_estimates": (token_estimates, "SELECT doc_id, CAST(floor(length(text) / 2.5) AS INTEGER) AS by_chars, CAST(floor(length(text) / 4) AS INTEGER) AS by_four FROM documents"),
    "normalise_whitespace": (normalise_whitespace, "SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(text, chr(160), ' '), chr(8232), chr(10)), chr(8233), chr(10) || chr(10)), '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS digest FROM documents"),
    "verify_hashes": (verify_hashes, "SELECT page_id, sha256(html) AS digest, strlen(html) AS n_bytes FROM pages"),
    "scan_json_props": (scan_json_props, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "score_fields": (score_fields, f"SELECT accession, field, {VERDICT} AS verdict FROM {SCORES}"),
    "upsert_merge": (upsert_merge, f"SELECT coalesce(n.id, o.id) AS id, coalesce(n.company, o.company) AS company, CASE WHEN n.id IS NOT NULL THEN n.digest ELSE o.digest END AS digest, CASE WHEN n.id IS NOT NULL THEN n.v ELSE o.v END AS v FROM {OLD} FULL JOIN {NEW} ON o.id = n.id"),
    "interval_point_join": (interval_point_join, f"SELECT p.doc, p.pos, r.name FROM {POINTS} LEFT JOIN {REGIONS} ON r.doc = p.doc AND p.pos >= r.start AND p.pos < r.\"end\""),
    "fts_match_and": (fts(all_of=["the", "of", "license"]), f"SELECT doc_id FROM {_TOKENS} WHERE list_has_all(tokens, ['the', 'of', 'license'])"),
    "fts_match_or": (fts(any_of=["idiot", "licensed"]), f"SELECT doc_id FROM {_TOKENS} WHERE list_has_any(tokens, ['idiot', 'licensed'])"),
    "fts_match_not": (fts(all_of=["the"], none_of=["of"]), f"SELECT doc_id FROM {_TOKENS} WHERE list_contains(tokens, 'the') AND NOT list_contains(tokens, 'of')"),
    "fts_match_phrase": (fts(phrase=["of", "the"]), f"SELECT doc_id FROM {_TOKENS} WHERE contains(' ' || array_to_string(tokens, ' ') || ' ', ' of the ')"),
    "bm25_topk": (bm25_topk, _BM25),
    "dense_topk_batch": (dense_topk_batch, "SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) DESC, v.vec_id) AS rank FROM embeddings v JOIN embeddings q ON q.vec_id % 20 = 0) x WHERE rank <= 5"),
    "hybrid_rrf": (hybrid_rrf, f"SELECT id, round(sum(s), 9) AS score, count(*) AS n_runs FROM (SELECT id, 1.0 / (60 + rank) AS s FROM {RUN_A} UNION ALL SELECT id, 1.0 / (60 + rank) AS s FROM {RUN_B}) x GROUP BY id ORDER BY score DESC, id LIMIT 4"),
    "session_counts": (session_counts, "SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n FROM (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) <= 86400 THEN 0 ELSE 1 END AS new FROM (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) a) b) c GROUP BY 1, 2"),
    "stream_tumbling_counts": (streams.tumbling_counts, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "chunk_windows": (chunk_windows, None),
    "html_flat_text": (html_flat_text, None),
    "token_bucket_waits": (token_bucket_waits, None),
    "breaker_states": (breaker_states, None),
}


def queries() -> dict:
    return {k: _portable(v) for k, v in (PORTABLE | services.PORTABLE | records.PORTABLE).items()} | {k: f for k, (f, _) in (OWN | reports.QUERIES | services.QUERIES | facts.QUERIES | records.QUERIES | mechanisms.QUERIES).items()} | library.QUERIES


def oracle_sql() -> dict[str, str]:
    own = {k: s for k, (_, s) in (OWN | reports.QUERIES | services.QUERIES | facts.QUERIES | records.QUERIES | mechanisms.QUERIES).items() if s}
    return {k: duck(v) for k, v in (PORTABLE | services.PORTABLE | records.PORTABLE | own).items()}
