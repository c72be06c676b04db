"""Queries for writes, caches, projections, the one-call surface and streams, each with SQL for another engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api
from ..functions import text as T
from ..operators import tables
from ..sources.nested import EXHIBIT
from ..sources.tables import table
from ..streaming import windows as streams
from .fixtures import CARDS, FILES, FRESH, LISTED, MANIFEST, MODELS, NAMES, NEW_VECTORS, PATHS, RAW, REFUSALS, STORED, VECTORS, values



def _cards(spark, folder):
    return values(spark, folder, CARDS).groupBy("accession", "model", F.col("day").alias("evaluated_at")).agg(F.collect_list(F.struct("field", "verdict")).alias("scores"))


def scorecard_upsert(spark, folder):
    return tables.latest(values(spark, folder, STORED).unionByName(values(spark, folder, FRESH)), ["accession", "version", "model"], "evaluated")


def set_embeddings(spark, folder):
    return tables.with_new_values(values(spark, folder, VECTORS), values(spark, folder, NEW_VECTORS), "id", "embedding")


def verify_partition(spark, folder):
    return tables.verified(values(spark, folder, MANIFEST), values(spark, folder, FILES).withColumn("content", F.col("content").cast("binary")))


def embed_dedupe(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text", F.sha2("text", 256).alias("digest"))
    made = tables.computed_once(rows, "digest", lambda once: once.withColumn("n_words", F.size(F.split("text", " "))))
    return made.select("doc_id", "digest", "n_words")


def accuracy_by_field(spark, folder):
    return api.accuracy(_cards(spark, folder)).withColumn("accuracy", F.round("accuracy", 9))


def latest_scorecard(spark, folder):
    return api.latest_scorecard(_cards(spark, folder), "7").select("accession", "model", F.size("scores").alias("n"))


def verdict_pivot(spark, folder):
    return values(spark, folder, CARDS).groupBy("field").pivot("verdict", ["exact", "wrong", "abstained"]).agg(F.count(F.lit(1))).na.fill(0)


def index_health(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("text"), F.col("o_orderdate").cast("date").alias("filed"))
    return api.health(orders, "filed", F.lit("1999-01-01").cast("date")).select("n", "n_text", "age_seconds", "fresh")


def search(spark, folder):
    chunks = table(spark, folder, "documents").withColumnRenamed("doc_id", "chunk_id")
    return api.search(chunks, "the of -licensed", 10, F.col("lang") == "en", stemmed=False).select("chunk_id", "score", "n_runs")


def ask(spark, folder):
    chunks = table(spark, folder, "documents").withColumnRenamed("doc_id", "chunk_id")
    got = api.ask(chunks, "the of -licensed", 10, F.col("lang") == "en", stemmed=False)
    return got.select("chunk_id", F.sha2("citation.passage", 256).alias("passage"), F.col("citation.chunk_id").alias("cited"))


def cosine_pairs(spark, folder):
    v = table(spark, folder, "embeddings")
    return v.select("vec_id", F.round(T.cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("cosine"))


def decode_fallback(spark, folder):
    """Documents as bytes in UTF-8, in Windows-1252 with its quotes, and in Latin-1 with a byte that Windows lacks."""
    docs = table(spark, folder, "documents")
    one_byte = F.encode(F.regexp_replace("text", r"[^\x{20}-\x{7e}\x{a0}-\x{ff}]", "?"), "ISO-8859-1")
    kind = F.col("doc_id") % 3
    raw = F.when(kind == 0, F.encode("text", "UTF-8")).when(kind == 1, F.concat(F.unhex(F.lit("93")), one_byte, F.unhex(F.lit("94")))).otherwise(F.concat(F.unhex(F.lit("8193")), one_byte))
    return docs.select("doc_id", F.sha2(T.decoded(raw).cast("binary"), 256).alias("sha256"))


def safe_decimal(spark, folder):
    return values(spark, folder, RAW).select("k", "raw", T.safe_decimal(F.col("raw")).cast("double").alias("value"))


_CARD_ROWS = f"SELECT field, count(*) AS n, round(avg((verdict IN ('exact','within_tolerance'))::INT), 9) AS accuracy, avg((verdict IN ('exact','within_tolerance'))::INT) >= 0.9 AS passed FROM {CARDS} WHERE verdict <> 'unresolvable' GROUP BY field"
_BYTES = "regexp_replace(text, '[^\\x{20}-\\x{7e}\\x{a0}-\\x{ff}]', '?', 'g')"
_DECODED = f"SELECT doc_id, sha256(CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '“' || {_BYTES} || '”' ELSE chr(129) || chr(147) || {_BYTES} END) AS sha256 FROM documents"
_SEARCH = """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE lang = 'en'),
f AS (SELECT * FROM t WHERE list_has_all(w, ['the', 'of']) AND NOT list_contains(w, 'licensed')), p AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM f),
c AS (SELECT doc_id, w, i, lag(w) OVER o AS pw, lag(i) OVER o AS pi FROM p WHERE w IN ('the', 'of') WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, round(sum(CASE WHEN pw <> w THEN 0.1E0 / (i - pi) ELSE 0 END), 9) AS score FROM c GROUP BY doc_id)
SELECT doc_id AS chunk_id, round(1.0E0 / (60 + row_number() OVER (ORDER BY score DESC, doc_id)), 9) AS score, 1 AS n_runs FROM s ORDER BY 2 DESC LIMIT 10"""

#: name -> (function, SQL or None where tests/ compare instead)
QUERIES = {
    "scorecard_upsert": (scorecard_upsert, f"SELECT accession, version, model, max(evaluated) AS evaluated, arg_max(score, evaluated) AS score FROM (SELECT * FROM {STORED} UNION ALL SELECT * FROM {FRESH}) GROUP BY 1, 2, 3"),
    "set_embeddings": (set_embeddings, f"SELECT v.id, coalesce(n.embedding, v.embedding) AS embedding FROM {VECTORS} LEFT JOIN {NEW_VECTORS} ON n.id = v.id"),
    "verify_partition": (verify_partition, f"SELECT m.prefix, m.filename, coalesce(sha256(f.content) = m.sha256, false) AS ok FROM {MANIFEST} LEFT JOIN {FILES} ON f.prefix = m.prefix AND f.filename = m.filename"),
    "embed_dedupe": (embed_dedupe, "SELECT doc_id, sha256(text) AS digest, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words FROM documents"),
    "accuracy_by_field": (accuracy_by_field, _CARD_ROWS),
    "latest_scorecard": (latest_scorecard, f"SELECT accession, model, count(*) AS n FROM {CARDS} WHERE accession = '7' GROUP BY accession, model, day ORDER BY day DESC, model LIMIT 1"),
    "verdict_pivot": (verdict_pivot, f"SELECT field, sum((verdict = 'exact')::INT)::BIGINT AS exact, sum((verdict = 'wrong')::INT)::BIGINT AS wrong, sum((verdict = 'abstained')::INT)::BIGINT AS abstained FROM {CARDS} GROUP BY field"),
    "index_freshness": (index_health, "SELECT count(*) AS n, count(o_orderstatus) AS n_text, date_diff('day', max(o_orderdate)::DATE, DATE '1999-01-01') * 86400 AS age_seconds, date_diff('day', max(o_orderdate)::DATE, DATE '1999-01-01') * 86400 < 86400 AS fresh FROM orders"),
    "search": (search, _SEARCH),
    "ask": (ask, f"SELECT chunk_id, sha256(substring(text, 1, 300)) AS passage, chunk_id AS cited FROM ({_SEARCH}) s JOIN documents ON doc_id = chunk_id"),
    "cosine_pairs": (cosine_pairs, "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS cosine FROM embeddings"),
    "decode_fallback": (decode_fallback, _DECODED),
    "safe_decimal": (safe_decimal, f"SELECT k, raw, CASE WHEN raw <> 'NaN' THEN try_cast(raw AS DOUBLE) END AS value FROM {RAW}"),
    "stream_sliding_counts": (streams.sliding_counts, "SELECT strftime(date_trunc('hour', ts) - to_hours(CAST(k AS INTEGER)), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events, range(6) r(k) GROUP BY 1, 2"),
    "stream_foreach_batch": (streams.landed_then_scored, "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum((event_type = 'error')::INT)::BIGINT AS errors FROM events GROUP BY 1"),
}

#: Same text for both engines.
PORTABLE = {
    "classify_status": f"SELECT event_id, code, body, CASE WHEN code < 400 THEN 'ok' WHEN code = 429 AND lower(substr(body, 1, 400)) LIKE '%perday%' THEN 'final' WHEN code IN (408, 429, 500, 502, 503, 504) THEN 'retry' ELSE 'final' END AS class FROM {REFUSALS}",
    "date_parts": "SELECT o_orderkey, quarter(o_orderdate) AS q, year(o_orderdate) AS y, CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS fy FROM {orders}",
    "query_prefix": f"SELECT item_id, m, CASE WHEN lower(m) LIKE '%bge%' THEN 'prefixed: ' || q ELSE q END AS line FROM {MODELS}",
    "metrics_long": "SELECT event_type AS label, 'events_total' AS name, count(*) * 1.0E0 AS value FROM {events} GROUP BY event_type UNION ALL SELECT event_type, 'value_max', max(value) FROM {events} GROUP BY event_type",
    "alert_absent": "SELECT r.name, count(e.event_id) = 0 AS firing FROM (VALUES ('error'), ('heartbeat')) AS r(name) LEFT JOIN {events} e ON e.event_type = r.name GROUP BY r.name",
    "abstention_rules": f"SELECT field, listed OR val IS NULL AS abstained FROM {LISTED}",
    "accession_from_path": f"SELECT p, replace(regexp_replace(regexp_replace(p, '^.*/', ''), '[.]txt$', ''), '-', '') AS accession FROM {PATHS}",
}


def filter_regex(spark, folder):
    return values(spark, folder, NAMES).select("name", F.col("name").rlike(EXHIBIT).alias("exhibit"))


def filter_digit_ratio(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.is_index_text(F.col("text")).alias("is_index"))


QUERIES |= {
    "filter_regex": (filter_regex, f"SELECT name, regexp_matches(name, '(?i)exhibit|(^|[^a-z0-9])ex-?[0-9]') AS exhibit FROM {NAMES}"),
    "filter_digit_ratio": (filter_digit_ratio, "SELECT doc_id, (contains(h, 'index to') AND contains(h, 'page')) OR (contains(h, 'consolidated financial statements') AND length(regexp_replace(text, '[^0-9]', '', 'g')) < 0.02 * length(text)) AS is_index FROM (SELECT doc_id, text, lower(left(text, 400)) AS h FROM documents) x"),
}
