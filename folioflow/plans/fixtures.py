"""Relations that the test tables lack, derived from them by one SQL text that both engines run.

Tables stand in braces. What a query does with a relation is written twice, as library code and as SQL; only the rows
that both start from are shared."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import LINES, table, tasks_for

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_BRACED = re.compile(r"\{(" + "|".join(TABLES) + r")\}")


def duck(sql: str) -> str:
    """The text as the other engine runs it."""
    return _BRACED.sub(r"\1", sql)


def sparks(sql: str) -> str:
    """The text as Spark runs it."""
    out = re.sub(r'"(start|end)"', r"`\1`", sql.replace("AS VARCHAR(9)", "AS STRING").replace("AS VARCHAR", "AS STRING").replace("chr(10)", "char(10)"))
    out = re.sub(r"sha256\((\w+)\)", r"sha2(\1, 256)", out).replace("{", "{{").replace("}", "}}")
    return re.sub(r"\{\{(" + "|".join(TABLES) + r")\}\}", r"{\1}", out)


def values(spark: SparkSession, folder: str, fixture: str) -> DataFrame:
    given = {n: table(spark, folder, n) for n in sorted(set(_BRACED.findall(fixture)))}
    if _LINES in fixture:  # different lines are told by order, in tasks whose number follows the number of lines
        given["lineitem"] = given["lineitem"].repartition(tasks_for(given["lineitem"], LINES), "l_orderkey")
    return spark.sql("SELECT * FROM " + sparks(fixture), **given)


_K = "CAST(o_orderkey AS VARCHAR)"
#: Answers of orders beside their totals: right, close, off by a scale, far off, missing, abstained, without a truth or of a truth of zero.
SCORES = f"""(SELECT {_K} AS accession, CASE WHEN o_orderkey % 2 = 0 THEN 'revenue' ELSE 'assets' END AS field,
 CASE o_orderkey % 7 WHEN 0 THEN truth WHEN 1 THEN o_totalprice * 1.001E0 WHEN 2 THEN o_totalprice * 1000 WHEN 3 THEN o_totalprice / 1000 WHEN 4 THEN NULL WHEN 5 THEN o_totalprice * 2 ELSE 0.0E0 END AS val, truth, o_orderkey % 17 = 0 AS abstained
 FROM (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 0.0E0 ELSE o_totalprice END AS truth FROM {{orders}}) q) AS s"""
#: A store of documents and what comes in: languages gone, texts grown, documents added and left out.
OLD = "(SELECT 'k' || CAST(doc_id AS VARCHAR) AS id, lang AS company, CAST(n_chars AS VARCHAR) AS digest, n_chars AS v FROM {documents} WHERE lang <> 'es') AS o"
NEW = "(SELECT 'k' || CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang = 'de' THEN CAST(NULL AS VARCHAR(9)) ELSE source END AS company, CAST(n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END AS VARCHAR) AS digest, n_chars + 1 AS v FROM {documents} WHERE lang <> 'en') AS n"
#: Two ranked runs over customers.
RUN_A = "(SELECT c_custkey AS id, c_custkey + 1 AS rank FROM {customer} WHERE c_mktsegment <> 'BUILDING') AS a"
RUN_B = "(SELECT c_custkey AS id, 1 + (c_custkey * 7919) % 100003 AS rank FROM {customer} WHERE c_acctbal > 0) AS b"
_LINES = "(SELECT DISTINCT l_orderkey AS doc, CAST(l_linenumber AS INT) AS line FROM {lineitem}) q"
HEADINGS = f"(SELECT doc, CAST(doc % 2 AS INT) AS part, 10 * line AS pos, (doc * 7 + line * 13) % 9 AS num FROM {_LINES}) AS h"
REGIONS = f"(SELECT doc, 100 * line AS \"start\", CAST(100 * line + 10 + doc % 40 AS INT) AS \"end\", 'r' || CAST(line AS VARCHAR) AS name FROM {_LINES} WHERE doc % 5 <> 0) AS r"
POINTS = f"(SELECT doc, 100 * line + 25 AS pos FROM {_LINES}) AS p"
SPANS = f"(SELECT doc, 100 * line - 40 AS \"start\", 100 * line + 40 AS \"end\" FROM {_LINES}) AS s"
MARKS = f"(SELECT doc, CAST(100 * line + doc % 50 AS INT) AS pos FROM {_LINES} WHERE line <> 2) AS m"
#: Scorecards of customers, a row a field.
CARDS = f"(SELECT CAST(o_custkey AS VARCHAR) AS accession, 'm' || CAST(o_orderkey % 3 AS VARCHAR) AS model, o_orderkey % 30 AS day, o_orderpriority AS field, CASE WHEN o_orderkey % 10 < 6 THEN 'exact' ELSE CASE o_orderkey % 10 WHEN 6 THEN 'wrong' WHEN 7 THEN 'abstained' WHEN 8 THEN 'within_tolerance' ELSE CASE WHEN o_orderkey % 4 = 1 THEN 'unresolvable' ELSE 'hallucinated' END END END AS verdict FROM {{orders}}) AS c"
_SCORED = "CAST(o_custkey AS VARCHAR) AS accession, 'v' || CAST(o_orderkey % 2 AS VARCHAR) AS version, 'm' AS model"
STORED = f"(SELECT {_SCORED}, o_orderkey AS evaluated, o_totalprice AS score FROM {{orders}}) AS o"
FRESH = f"(SELECT {_SCORED}, o_orderkey + 5 AS evaluated, o_totalprice + 1 AS score FROM {{orders}} WHERE o_orderstatus = 'F') AS n"
VECTORS = "(SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS embedding FROM {customer}) AS v"
NEW_VECTORS = "(SELECT CAST(c_custkey + 5 AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey * 1.0E0 END AS embedding FROM {customer} WHERE c_mktsegment = 'BUILDING') AS n"
MANIFEST = "(SELECT source AS prefix, 'd' || CAST(doc_id AS VARCHAR) AS filename, CASE WHEN lang = 'de' THEN '00' ELSE sha256(text) END AS sha256 FROM {documents}) AS m"
FILES = "(SELECT source AS prefix, 'd' || CAST(doc_id AS VARCHAR) AS filename, text AS content FROM {documents} WHERE lang <> 'es') AS f"
REFUSALS = "(SELECT event_id, CASE event_id % 9 WHEN 0 THEN 200 WHEN 1 THEN 408 WHEN 2 THEN 429 WHEN 3 THEN 429 WHEN 4 THEN 404 WHEN 5 THEN 500 WHEN 6 THEN 400 WHEN 7 THEN 403 ELSE 503 END AS code, CASE WHEN event_id % 9 = 2 THEN 'limit PerDay reached' ELSE props END AS body FROM {events}) AS r"
NAMES = "(SELECT CASE p_partkey % 6 WHEN 0 THEN 'aapl-ex' || CAST(p_partkey AS VARCHAR) || '.htm' WHEN 1 THEN 'exhibit' || CAST(p_partkey AS VARCHAR) || '.htm' WHEN 2 THEN 'index' || CAST(p_partkey AS VARCHAR) || '.htm' WHEN 3 THEN 'complex' || CAST(p_partkey AS VARCHAR) || '.htm' WHEN 4 THEN 'a_ex' || CAST(p_partkey AS VARCHAR) || '.txt' ELSE p_name || '.html' END AS name, CAST(p_size * 100 + p_partkey % 100 AS BIGINT) AS size, p_partkey AS k FROM {part}) AS n"
RAW = f"(SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN {_K} || '.5' WHEN 1 THEN {_K} || 'e3' WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN 'NaN' ELSE '-' || {_K} END AS raw FROM {{orders}}) AS r"
KEYS = "(SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'CIK000' || CAST(c_custkey AS VARCHAR) WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN '0' ELSE '' END AS raw FROM {customer}) AS t"
PATHS = "(SELECT 'edgar/data/' || CAST(o_custkey AS VARCHAR) || '/0000-24-' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderstatus = 'F' THEN '.txt' ELSE '' END AS p FROM {orders}) AS t"
MODELS = "(SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'BGE-small' ELSE 'other' END AS m, text AS q FROM {benchmark}) AS t"
LISTED = "(SELECT doc_id AS field, lang = 'de' AS listed, CASE WHEN n_chars < 200 THEN NULL ELSE n_chars * 1.0E0 END AS val FROM {documents}) AS t"
#: Answers as text: right, no number, missing, off by a thousand, far off, twice as much, empty; and truths that are missing.
ANSWERS = f"""(SELECT {_K} AS accession, 'revenue' AS field, CASE o_orderkey % 8 WHEN 0 THEN t WHEN 1 THEN 'abc' WHEN 2 THEN CAST(NULL AS VARCHAR) WHEN 3 THEN t || '000' WHEN 4 THEN t || '0' || t WHEN 5 THEN t || '.5' WHEN 6 THEN '2' || t ELSE t END AS raw,
 CASE WHEN o_orderkey % 8 = 7 THEN CAST(NULL AS VARCHAR) ELSE t END AS truth FROM (SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS t FROM {{orders}}) q) AS a"""
CITED = f"(SELECT {_K} AS accession, o_orderpriority AS field, CASE WHEN o_orderkey % 3 = 0 THEN 'exact' ELSE CASE WHEN o_orderkey % 3 = 1 THEN 'within_tolerance' ELSE 'wrong' END END AS verdict, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'c' || CAST(o_orderkey % 50 AS VARCHAR) || ',c' || CAST(o_orderkey % 70 AS VARCHAR) END AS cited FROM {{orders}}) AS s"
CHUNKS = "(SELECT 'c' || CAST(p_partkey AS VARCHAR) AS chunk_id, CASE WHEN p_partkey % 3 = 0 THEN 'table' ELSE 'prose' END AS chunk_type FROM {part} WHERE p_partkey <> 40) AS c"
SIZES = "(SELECT CAST(l_linenumber AS INT) AS budget, CAST(l_orderkey % 5000 AS BIGINT) AS tokens, l_returnflag = 'N' AS covered FROM {lineitem}) AS s"
PROBED = "(SELECT CAST(year(o_orderdate) AS INT) AS fy, CASE WHEN o_orderkey % 2 = 0 THEN 'revenue' ELSE 'assets' END AS field, CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS VARCHAR) ELSE o_orderpriority END AS tag, o_orderkey % 9 = 0 AS restated FROM {orders}) AS p"
BUCKETS = "(SELECT route, le, n FROM (" + " UNION ALL ".join(f"SELECT event_type AS route, {b}E0 AS le, sum(CASE WHEN value <= {b}E0 THEN 1 ELSE 0 END) AS n FROM {{events}} WHERE value <= 200.0E0 GROUP BY event_type" for b in ("5.0", "20.0", "50.0", "200.0")) + ") q) AS b"
ITEMS = "(SELECT DISTINCT CAST(l_linenumber AS VARCHAR) || CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'b' ELSE '' END AS item, CASE WHEN l_linestatus = 'O' THEN '10-K' ELSE '10-Q' END AS form FROM {lineitem}) AS i"
#: Items as reports write them: with the word and signs, with small letters, unknown, missing.
TAGGED = """(SELECT DISTINCT CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN ' item ' || n || '. ' WHEN 1 THEN CAST(NULL AS VARCHAR) WHEN 2 THEN n || 'x' WHEN 3 THEN n || 'a' ELSE n END AS item,
 CASE WHEN l_linestatus = 'O' THEN '10-K/A' ELSE '10-q' END AS form FROM (SELECT *, CAST(l_partkey % 18 AS VARCHAR) AS n FROM {lineitem}) q) AS i"""
#: Figures of orders, whole, in thousands or millions, below zero, with a fraction or missing; and texts that print them or not.
CONTEXTS = f"""(SELECT {_K} AS accession, o_orderpriority AS field, CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE) WHEN o_orderkey % 13 = 0 THEN -1.0E0 * t * k WHEN o_orderkey % 7 = 0 THEN t * k + 0.5E0 ELSE 1.0E0 * t * k END AS truth,
 CASE o_orderkey % 4 WHEN 0 THEN 'sales of ' || CAST(t AS VARCHAR) || ' in all' WHEN 1 THEN 'nothing' WHEN 2 THEN 'a loss of (' || CAST(t * k AS VARCHAR) || ')' ELSE CAST(CAST(floor(t / 1000.0E0) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(t % 1000 AS VARCHAR), 3, '0') END AS context
 FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS t, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS k FROM {{orders}}) q) AS c"""
REPORT = """(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '10-K' ELSE '10-Q' END AS form, 'Front' || chr(10) || 'PART I' || chr(10) || 'Item ' || CAST(1 + doc_id % 15 AS VARCHAR) || '. ' || source || chr(10) || 'text é😀' || chr(10) || 'Item ' || CAST(1 + n_chars % 15 AS VARCHAR) || chr(10) || ' ITEM 1A - Risk of ' || lang || '.' || chr(10) || 'see Item 9 there' || chr(10) || 'PART II' || chr(10) || 'Item 1 Legal' || chr(10) || 'end' AS text FROM {documents}) AS d"""
#: Replies of a model about orders: fenced, without a figure, no JSON, with a figure that is none; and a second reply for some.
COMPLETIONS = f"""(SELECT {_K} AS id, CASE o_orderkey % 4 WHEN 0 THEN '```json' || chr(10) || '{{"total_revenue": "' || {_K} || '.5", "confidence": 0.9, "abstained_fields": ["net_income", "other"]}}' || chr(10) || '```' WHEN 1 THEN '{{"total_revenue": null}}' WHEN 2 THEN 'not json' ELSE '{{"total_revenue":"NaN","net_income":' || {_K} || ',"fiscal_year":2021}}' END AS reply, o_orderkey AS k FROM {{orders}}) AS t"""
ASKED = f"""(SELECT {_K} AS id, CASE o_orderkey % 5 WHEN 0 THEN '{{"total_revenue": ' || {_K} || ', "confidence": 0.5}}' WHEN 1 THEN 'no json' WHEN 2 THEN '{{"total_revenue": 4' WHEN 3 THEN CAST(NULL AS VARCHAR) ELSE 'nothing' END AS reply,
 CASE o_orderkey % 5 WHEN 1 THEN '{{"net_income": "' || {_K} || '.5"}}' WHEN 2 THEN 'still {{' WHEN 3 THEN '{{"total_revenue": 2, "net_income": 1}}' ELSE CAST(NULL AS VARCHAR) END AS again FROM {{orders}}) AS t"""
STATUS = "(SELECT event_id, CASE event_id % 8 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 429 WHEN 4 THEN 500 WHEN 5 THEN 503 WHEN 6 THEN 502 ELSE 401 END AS code FROM {events}) AS t"
