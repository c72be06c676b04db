"""Queries for nested sources, structure, scoring, reports and service rules, each with SQL for another engine.

Columns that the tables lack are derived from theirs (fixtures.py); the operators are the library's own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sections, text as T
from ..operators import alerts, headings, html_tables, intervals, percentiles, replies, retrieval
from ..sources import configs, nested
from ..sources.tables import table, tasks_for
from . import mechanisms
from .fixtures import ANSWERS, ASKED, BUCKETS, CHUNKS, CITED, COMPLETIONS, CONTEXTS, ITEMS, MARKS, NAMES, POINTS, PROBED, REGIONS, REPORT, SIZES, SPANS, TAGGED, values

#: Lines whose spans and regions one task cuts, more or less.
SPLIT_LINES = 250_000


def _bodies(rows: DataFrame, group, item, body) -> DataFrame:
    """JSON bodies of fifty rows or so: what body makes of the array of their items."""
    held = rows.select(group.alias("g"), item.alias("i")).groupBy("g").agg(F.sort_array(F.collect_list("i")).alias("items"))
    return held.select(F.to_json(body(F.col("items"))).alias("body"))


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Directories of parts, fifty files each."""
    item = F.struct("name", F.col("size").cast("string").alias("size"))
    return _bodies(values(spark, folder, NAMES), F.floor(F.col("k") / 50), item, lambda a: F.struct(F.struct(F.lit("/d").alias("name"), a.alias("item")).alias("directory")))


def scan_json_listing(spark, folder):
    return nested.listing(_listing(spark, folder))


def argmax_primary_doc(spark, folder):
    return nested.primary_document(nested.listing(_listing(spark, folder)))


def scan_nested_facts(spark, folder):
    path = mechanisms.fact_bodies(spark, folder)
    bodies = spark.read.text(path).select(F.get_json_object("value", "$.facts").alias("body"))
    return nested.observations(bodies).select("taxonomy", "tag", "unit", F.col("val").cast("double").alias("val"), F.col("start_d").cast("string").alias("start_d"), F.col("end_d").cast("string").alias("end_d"), "form", F.col("filed").cast("string").alias("filed"), "accn")


def scan_arrays_zip(spark, folder):
    item = F.struct(F.col("o_orderkey").cast("string").alias("a"), F.when(F.col("o_orderstatus") == "F", "10-K").otherwise("8-K").alias("f"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("p"))
    names = {"accessionNumber": "a", "form": "f", "filingDate": "d", "primaryDocument": "p"}
    body = lambda a: F.struct(*(a[k].alias(n) for n, k in names.items()))
    return nested.submissions(_bodies(table(spark, folder, "orders"), F.floor(F.col("o_orderkey") / 50), item, body))


def scan_map_values(spark, folder):
    item = F.struct(F.col("c_custkey").alias("cik_str"), F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("title"))
    body = lambda a: F.map_from_entries(F.transform(a, lambda x, i: F.struct(i.cast("string").alias("k"), x.alias("v"))))
    return nested.tickers(_bodies(table(spark, folder, "customer"), F.floor(F.col("c_custkey") / 50), item, body))


def scan_query_set(spark, folder):
    item = F.struct(F.col("c_name").alias("ticker"), F.col("c_custkey").cast("string").alias("cik"), F.col("c_mktsegment").alias("sector"))
    rows = _bodies(table(spark, folder, "customer"), F.floor(F.col("c_custkey") / 50), item, lambda a: F.struct(a.alias("companies")))
    return nested.companies(rows).select("ticker", T.padded_id(F.col("cik")).alias("cik"), "sector")


def array_minmax_span(spark, folder):
    rows = table(spark, folder, "orders").withColumn("y", F.year("o_orderdate"))
    rows = rows.groupBy(F.floor(F.col("o_orderkey") / 50).alias("block")).agg(F.to_json(F.struct(F.collect_list("y").alias("fiscal_years"))).alias("body"))
    return rows.select("block", F.from_json("body", "fiscal_years array<int>").alias("u")).select("block", F.array_min("u.fiscal_years").alias("first"), F.array_max("u.fiscal_years").alias("last"))


def item_headings(spark, folder):
    return headings.item_headings(values(spark, folder, REPORT))


def part_headings(spark, folder):
    return headings.part_headings(values(spark, folder, REPORT))


def item_regions(spark, folder):
    return headings.item_regions(values(spark, folder, REPORT)).withColumnRenamed("start", "from_char").withColumnRenamed("end", "to_char")


_LINES = f"(SELECT doc_id, form, ls, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, form, string_split(text, chr(10)) AS ls FROM {REPORT}) q) l"
_POS = "coalesce(list_sum(list_transform(ls[1:i - 1], lambda x: length(x) + 1)), 0)::BIGINT"
_PART = r"(?i)^[ \t]*PART[ \t]+([IVX]{1,4})\b"
_ITEM = r"(?i)^[ \t]*Item[ \t]+([0-9]{1,2}[A-C]?)(?:[ \t]*[.:—–-]+[ \t]*(.{0,120})|[ \t]+(\S.{0,119}))$"


_SECTIONS = "(VALUES " + ", ".join("(%s, '%s', '%s')" % (quarterly, item, name.replace("'", "''")) for quarterly, names in ((False, sections.ANNUAL), (True, sections.QUARTERLY)) for item, name in names.items()) + ") AS n(quarterly, number, section)"
_REGIONS = f"""WITH h AS (SELECT doc_id, form, {_POS} AS pos, length(array_to_string(ls, chr(10))) AS len, regexp_matches(line, '{_PART}') AS part, upper(regexp_extract(line, '{_ITEM}', 1)) AS item, trim(concat(regexp_extract(line, '{_ITEM}', 2), regexp_extract(line, '{_ITEM}', 3)), ' .:-—–') AS title
 FROM {_LINES} WHERE regexp_matches(line, '{_ITEM}') OR regexp_matches(line, '{_PART}')),
p AS (SELECT *, sum(part::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS pt, 10 * TRY_CAST(regexp_extract(item, '^[0-9]+') AS INT) + CASE right(item, 1) WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 ELSE 0 END AS o FROM h),
k AS (SELECT *, max(o) OVER (PARTITION BY doc_id, pt ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM p WHERE NOT part),
r AS (SELECT doc_id, form, pos AS from_char, lead(pos, 1, len) OVER (PARTITION BY doc_id ORDER BY pos) AS to_char, item, title FROM k WHERE best IS NULL OR o > best)
SELECT doc_id, from_char, to_char, item, title, coalesce(section, 'Unknown') AS section FROM r LEFT JOIN {_SECTIONS} ON number = item AND quarterly = (form = '10-Q')"""
_TAGS = f"""SELECT item, form, coalesce(section, 'Unknown') AS section, coalesce(section IN ({", ".join("'" + name.replace("'", "''") + "'" for name in sections.PRIMARY)}), false) AS is_primary FROM {TAGGED}
 LEFT JOIN {_SECTIONS} ON number = trim(upper(replace(lower(item), 'item', '')), ' .:') AND quarterly = (upper(form) LIKE '10-Q%')"""


def section_tag(spark, folder):
    s = sections.section(F.col("item"), F.col("form"))
    return values(spark, folder, TAGGED).select("item", "form", s.alias("section"), sections.is_primary(s).alias("is_primary"))


def item_sort(spark, folder):
    o = sections.item_order(F.col("item"))
    return values(spark, folder, ITEMS).filter("item is not null").select("item", o["number"].alias("number"), o["letter"].alias("letter"))


def interval_split(spark, folder):
    tasks = tasks_for(table(spark, folder, "lineitem"), SPLIT_LINES)
    got = intervals.split_at(values(spark, folder, SPANS), values(spark, folder, REGIONS), "doc", tasks)
    return got.select("doc", F.col("start").alias("from_char"), F.col("end").alias("to_char"), "name")


def asof_running_count(spark, folder):
    return intervals.counted_before(values(spark, folder, POINTS), values(spark, folder, MARKS), "doc").withColumn("n", F.col("n").cast("bigint"))


def score_verdicts(spark, folder):
    value, truth = T.safe_decimal(F.col("raw")), T.safe_decimal(F.col("truth"))
    bad = F.col("raw").isNotNull() & value.isNull()
    return values(spark, folder, ANSWERS).select("accession", T.verdict(value, truth, F.lit(False), others=F.array(F.lit(110).cast("decimal(38,4)")), unreadable=bad).alias("verdict"))


def score_primitives(spark, folder):
    v, t = T.safe_decimal(F.col("raw")), T.safe_decimal(F.col("truth"))
    return values(spark, folder, ANSWERS).select("accession", F.round(T.relative_error(v, t), 9).alias("error"), F.round(T.magnitude_ratio(v, t), 9).alias("ratio"), T.scale_factor(v, t).alias("scale"))


def _kinds(spark: SparkSession, folder: str) -> DataFrame:
    cites = values(spark, folder, CITED).select("*", F.explode_outer(F.split("cited", ",")).alias("chunk_id"))
    per = cites.join(values(spark, folder, CHUNKS), "chunk_id", "left").groupBy("accession", "field", "verdict").agg(F.max(F.col("chunk_type") == "table").alias("t"))
    return per.select("accession", "field", "verdict", F.when(F.col("t"), "table").when(~F.col("t"), "prose").otherwise("unknown").alias("kind"))


def source_kind(spark, folder):
    return _kinds(spark, folder).select("accession", "field", "kind")


def accuracy_by_source_kind(spark, folder):
    return _kinds(spark, folder).groupBy("kind").agg(F.count("*").alias("total"), F.count_if(F.col("verdict").isin("exact", "within_tolerance")).alias("correct"))


def parse_completion(spark, folder):
    got = nested.completions(values(spark, folder, COMPLETIONS), "id", "reply", 2023)
    return got.withColumns({c: F.col(c).cast("double") for c in ("total_revenue", "net_income")})


def abstain_fallback(spark, folder):
    rows = values(spark, folder, ASKED)
    first = nested.completions(rows, "id", "reply", 2023)
    second = nested.completions(rows.filter("again IS NOT NULL").join(replies.unfit(first, "id"), "id", "left_semi"), "id", "again", 2023)
    return replies.settled(first, second, "id").select("id", "ok", "attempts", *(F.col(c).cast("double").alias(c) for c in ("total_revenue", "net_income")), "confidence", "abstained")


def scan_labelled_queries(spark, folder):
    names = F.concat(F.lit("Customer#"), F.lpad((F.col("item_id") * 7).cast("string"), 9, "0"))
    item = F.struct(F.col("item_id").cast("string").alias("id"), F.col("text").alias("query"), names.alias("ticker"), F.when(F.col("item_id") % 2 == 0, "10-K").otherwise("10-Q").alias("form"), F.array(F.lit("1"), F.lit("7")).alias("items"))
    rows = _bodies(table(spark, folder, "benchmark"), F.floor(F.col("item_id") / 50), item, lambda a: F.struct(a.alias("queries")))
    got = nested.labelled_queries(rows, scan_query_set(spark, folder))
    return got.select("id", "query", "ticker", "form", F.array_join("items", ",").alias("items"), "cik")


def scan_tag_map(spark, folder):
    """A configuration an order: return flags as fields, parts as the tags that may stand for them."""
    line = F.struct(F.col("l_linenumber").alias("at"), (F.col("l_partkey") % 5).alias("p"))
    held = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    units = F.when(F.col("l_returnflag") != "A", F.array(F.lit("USD"), F.lit("EUR")))
    period = F.when(F.col("l_returnflag") == "R", "instant").otherwise("duration")
    spec = F.struct(period.alias("period"), units.alias("units"), F.transform("lines", lambda x: F.concat(F.lit("Tag"), x["p"].cast("string"))).alias("tags"))
    body = F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("l_returnflag", spec))).alias("fields")))
    return configs.tag_maps(held.groupBy("l_orderkey").agg(body.alias("body")), "l_orderkey")


_TAG_MAPS = """SELECT l_orderkey, field, CASE WHEN field = 'R' THEN 'instant' ELSE 'duration' END AS period, unit, 'Tag' || p AS tag, CAST(row_number() OVER (PARTITION BY l_orderkey, field, unit ORDER BY first) - 1 AS INTEGER) AS pref
 FROM (SELECT l_orderkey, l_returnflag AS field, l_partkey % 5 AS p, min(l_linenumber * 10 + l_partkey % 5) AS first FROM lineitem GROUP BY ALL) t, (VALUES ('USD'), ('EUR')) AS u(unit) WHERE unit = 'USD' OR field <> 'A'"""


def value_forms_contains(spark, folder):
    return values(spark, folder, CONTEXTS).select("accession", "field", F.exists(T.figure_forms(F.col("truth")), lambda f: F.col("context").contains(f)).alias("found"))


def context_coverage(spark, folder):
    found = F.exists(T.figure_forms(F.col("truth")), lambda f: F.col("context").contains(f))
    rows = values(spark, folder, CONTEXTS).select("field", "truth", found.alias("found"))
    return rows.groupBy("field").agg(F.count_if(F.col("truth").isNotNull() & F.col("found")).alias("covered"), F.count_if(F.col("truth").isNotNull() & ~F.col("found")).alias("missing"), F.count_if(F.col("truth").isNull()).alias("unresolvable"))


_FORM = "(v % {0} = 0 AND (contains(context, CAST(v // {0} AS VARCHAR)) OR contains(context, format('{{:,}}', v // {0}))))"
_FOUND = f"(SELECT accession, field, truth, coalesce(v <> 0 AND v = abs(truth) AND ({' OR '.join(_FORM.format(k) for k in (1, 1000, 1000000))}), false) AS found FROM (SELECT *, CAST(floor(abs(truth)) AS BIGINT) AS v FROM {CONTEXTS}) q) f"


def budget_sweep(spark, folder):
    rows = values(spark, folder, SIZES)
    per = rows.groupBy("budget").agg(F.avg(F.col("covered").cast("int")).alias("coverage"), F.max("tokens").alias("most"))
    mid = percentiles.at_places(rows, "budget", "tokens", {"mid": F.floor(F.col("n") / 2)})
    return per.join(mid, "budget").select("budget", "coverage", F.col("mid").cast("bigint").alias("mid"), "most", (F.col("most") + 1500 < 4000).alias("fits"))


def resolution_probe(spark, folder):
    rows = values(spark, folder, PROBED)
    tags = rows.filter("tag is not null").groupBy("fy", "field", "tag").agg(F.count("*").alias("n")).groupBy("fy", "field").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "tag"))).alias("t"))
    per = rows.groupBy("fy", "field").agg(F.count("tag").alias("resolved"), F.count_if(F.col("tag").isNull()).alias("failed"), F.count_if("restated").alias("restated"))
    top = F.array_join(F.transform(F.slice("t", 1, 4), lambda x: x["tag"]), ",")
    return per.join(tags, ["fy", "field"], "left").select("fy", "field", "resolved", "failed", "restated", F.coalesce(top, F.lit("")).alias("top_tags"), (F.col("resolved") / (F.col("resolved") + F.col("failed")) >= 0.7).alias("passed"))


def relevance_ceiling(spark, folder):
    """Users as queries and their error events as the relevant rows: what precision at ten can reach at best."""
    per = table(spark, folder, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n"))
    per = per.select(F.least("n", F.lit(10)) / 10 * 1.0)
    return per.toDF("c").agg(F.round(F.avg("c"), 6).alias("ceiling"), F.count_if(F.col("c") < 1).alias("under"))


def table_layout_flag(spark, folder):
    """A page an order: a table of its lines, of which some have figures, and a table of one row."""
    figure = F.when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(F.format_number("l_extendedprice", 0))
    row = F.concat(F.lit("<tr><td>part "), F.col("l_partkey").cast("string"), F.lit("</td><td>"), figure, F.lit("</td></tr>"))
    # Small bytes are much work here: a stated number of tasks is not put together into few, as Spark does by size.
    lines = table(spark, folder, "lineitem").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    pages = lines.groupBy(F.col("l_orderkey").alias("page_id")).agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("rows"))
    html = F.concat(F.lit("<p>lines</p><table>"), "rows", F.lit("</table><table><tr><td>a</td><td>b</td></tr></table>"))
    return html_tables.extracted(pages.select("page_id", html.alias("html"))).select("page_id", "ordinal", "layout")


_LAYOUT = """WITH o AS (SELECT l_orderkey AS page_id, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'N') AS figures FROM lineitem GROUP BY 1)
SELECT page_id, 0 AS ordinal, n < 2 OR (n < 4 AND 10 * figures < 2 * n) AS layout FROM o UNION ALL SELECT page_id, 1, true FROM o"""


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return alerts.steps(e, "event_type", F.unix_seconds(F.col("ts").cast("timestamp")), F.col("value") > 20)


def slo_burn(seconds: int):
    return lambda spark, folder: alerts.burn_rates(_steps(spark, folder), "event_type", seconds, 0.9)


def _burn_sql(seconds: int) -> str:
    share = f"sum(bad) OVER w / sum(total) OVER w FROM s WINDOW w AS (PARTITION BY event_type ORDER BY step RANGE BETWEEN {seconds - 1} PRECEDING AND CURRENT ROW)"
    return f"WITH s AS (SELECT event_type, CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) AS step, count(*) AS total, sum((value > 20)::INT) AS bad FROM events GROUP BY 1, 2) SELECT event_type, step, round(b / (1 - 0.9E0), 6) AS burn FROM (SELECT event_type, step, {share.replace(' FROM s', ' AS b FROM s')}) x"


def histogram_quantile(spark, folder):
    return alerts.histogram_quantile(values(spark, folder, BUCKETS), "route", 0.95).withColumn("value", F.round("value", 9))


def alert_for_duration(spark, folder):
    """Hours of an event type in which most values are high, if they last three hours or more."""
    e = table(spark, folder, "events")
    hours = alerts.steps(e, "event_type", F.unix_seconds(F.col("ts").cast("timestamp")), F.col("value") > 20, 3600)
    return alerts.held(hours.withColumn("firing", F.col("bad") * 2 > F.col("total")), "event_type", "step", "firing", 7200)


_HELD = """WITH h AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS step, sum((value > 20)::INT) * 2 > count(*) AS firing FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY step) - row_number() OVER (PARTITION BY event_type, firing ORDER BY step) AS run FROM h)
SELECT event_type, min(step) AS since, max(step) AS until FROM r WHERE firing GROUP BY event_type, run HAVING max(step) - min(step) >= 7200"""


def alert_inhibition(spark, folder):
    """Errors of users who have no high value of any other kind in the same hour."""
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", F.date_trunc("hour", "ts").alias("hour"))
    return alerts.inhibited(e.filter("event_type = 'error'"), e.filter("event_type <> 'error' AND value > 60"), ["user_id", "hour"]).select("event_id")


_INHIBITED = "SELECT event_id FROM events t WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type <> 'error' AND s.value > 60 AND s.user_id = t.user_id AND date_trunc('hour', s.ts) = date_trunc('hour', t.ts))"


def cover_density_rank(spark, folder):
    rows = retrieval.with_tokens(table(spark, folder, "documents"))
    score = F.round(retrieval.cover_density(F.col("tokens"), ["the", "of"]), 9)
    return rows.select("doc_id", score.alias("score")).filter("score > 0")


_COVER = """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t), q AS (SELECT * FROM p WHERE w IN ('the', 'of')),
c AS (SELECT doc_id, w, i, lag(w) OVER o AS pw, lag(i) OVER o AS pi FROM q WINDOW o AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, round(sum(0.1E0 / (i - pi)), 9) AS score FROM c WHERE pw <> w GROUP BY doc_id"""


def web_search_filter(spark, folder):
    rows = retrieval.with_tokens(table(spark, folder, "documents"))
    return rows.filter(retrieval.web_condition(F.col("tokens"), 'the OR idiot -licensed "of the"')).select("doc_id")


_TOKENS = "(SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS tokens FROM documents) d"


def hive_prefix(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.concat(F.lit("source="), T.path_segment(F.col("source")), F.lit("/lang="), T.path_segment(F.concat("lang", F.lit("/x y")))).alias("prefix"))


_OBJECT = "coalesce(CASE WHEN json_valid({0}) THEN json_type({0}::JSON) = 'OBJECT' ELSE false END, false)"
_FIGURE = "CAST(CASE WHEN a THEN reply::JSON ->> '{0}' WHEN b THEN again::JSON ->> '{0}' END AS DOUBLE)"

#: name -> (function, SQL or None where tests/ compare instead)
QUERIES = {
    "scan_json_listing": (scan_json_listing, f"SELECT name, size FROM {NAMES}"),
    "argmax_primary_doc": (argmax_primary_doc, f"SELECT name FROM {NAMES} WHERE regexp_matches(name, '(?i)[.]html?$') AND NOT contains(lower(name), 'index') AND NOT regexp_matches(name, '(?i)exhibit|(^|[^a-z0-9])ex-?[0-9]') ORDER BY size DESC, name DESC LIMIT 1"),
    "scan_nested_facts": (scan_nested_facts, "SELECT taxonomy, tag, unit, val, CAST(start_d AS VARCHAR) AS start_d, CAST(end_d AS VARCHAR) AS end_d, form, CAST(filed AS VARCHAR) AS filed, accn FROM (" + mechanisms.FACT_ROWS + ") x"),
    "scan_arrays_zip": (scan_arrays_zip, "SELECT CAST(o_orderkey AS VARCHAR) AS accession, CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '8-K' END AS form, strftime(o_orderdate, '%Y-%m-%d') AS filed, o_orderkey || '.htm' AS document FROM orders"),
    "scan_map_values": (scan_map_values, "SELECT c_name AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_mktsegment AS title FROM customer"),
    "scan_query_set": (scan_query_set, "SELECT c_name AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_mktsegment AS sector FROM customer"),
    "array_minmax_span": (array_minmax_span, "SELECT o_orderkey // 50 AS block, min(year(o_orderdate)) AS first, max(year(o_orderdate)) AS last FROM orders GROUP BY 1"),
    "item_headings": (item_headings, f"SELECT doc_id, {_POS} AS pos, upper(regexp_extract(line, '{_ITEM}', 1)) AS item, trim(concat(regexp_extract(line, '{_ITEM}', 2), regexp_extract(line, '{_ITEM}', 3)), ' .:-—–') AS title FROM {_LINES} WHERE regexp_matches(line, '{_ITEM}')"),
    "part_headings": (part_headings, f"SELECT doc_id, {_POS} AS pos, upper(regexp_extract(line, '(?i)^[ \\t]*PART[ \\t]+([IVX]{{1,4}})\\b', 1)) AS part FROM {_LINES} WHERE regexp_matches(line, '(?i)^[ \\t]*PART[ \\t]+([IVX]{{1,4}})\\b')"),
    "item_regions": (item_regions, _REGIONS),
    "section_tag": (section_tag, _TAGS),
    "item_sort": (item_sort, f"SELECT item, CASE WHEN regexp_full_match(upper(item), '[0-9]+[A-C]?') THEN CAST(regexp_extract(item, '^[0-9]+') AS INTEGER) ELSE 999 END AS number, CASE WHEN regexp_full_match(upper(item), '[0-9]+[A-C]?') THEN regexp_extract(upper(item), '[A-C]?$') ELSE upper(item) END AS letter FROM {ITEMS} WHERE item IS NOT NULL"),
    "interval_split": (interval_split, f"WITH e AS (SELECT s.doc, s.\"start\" AS a, s.\"end\" AS b, p FROM {SPANS} JOIN (SELECT doc, \"start\" AS p FROM {REGIONS} UNION SELECT doc, \"end\" FROM {REGIONS}) r ON r.doc = s.doc AND r.p > s.\"start\" AND r.p < s.\"end\" UNION SELECT s.doc, s.\"start\", s.\"end\", s.\"start\" FROM {SPANS} ), g AS (SELECT doc, p AS from_char, lead(p, 1, b) OVER (PARTITION BY doc, a ORDER BY p) AS to_char FROM e) SELECT g.doc, from_char, to_char, r.name FROM g LEFT JOIN {REGIONS} ON r.doc = g.doc AND from_char >= r.\"start\" AND from_char < r.\"end\""),
    "asof_running_count": (asof_running_count, f"SELECT p.doc, p.pos, count(m.pos) AS n FROM {POINTS} LEFT JOIN {MARKS} ON m.doc = p.doc AND m.pos <= p.pos GROUP BY 1, 2"),
    "score_verdicts": (score_verdicts, f"SELECT accession, CASE WHEN t IS NULL THEN 'unresolvable' WHEN bad THEN 'hallucinated' WHEN v IS NULL THEN 'abstained' WHEN v = t THEN 'exact' WHEN abs(v - t) / t <= 0.005 THEN 'within_tolerance' WHEN abs(v / 1e3 - t) / t <= 0.005 OR abs(v / 1e6 - t) / t <= 0.005 OR abs(v / 1e9 - t) / t <= 0.005 THEN 'scale_error' WHEN greatest(v, t) / least(v, t) > 10 THEN 'hallucinated' ELSE 'wrong' END AS verdict FROM (SELECT accession, try_cast(raw AS DOUBLE) AS v, try_cast(truth AS DOUBLE) AS t, raw IS NOT NULL AND try_cast(raw AS DOUBLE) IS NULL AS bad FROM {ANSWERS}) x"),
    "score_primitives": (score_primitives, f"SELECT accession, round(abs(v - t) / abs(t), 9) AS error, CASE WHEN v IS NOT NULL AND t IS NOT NULL THEN round(greatest(v, t) / least(v, t), 9) END AS ratio, CASE WHEN abs(v * 1e3 - t) / t <= 0.005 THEN 1000 WHEN abs(v / 1e3 - t) / t <= 0.005 THEN -1000 WHEN abs(v * 1e6 - t) / t <= 0.005 THEN 1000000 WHEN abs(v / 1e6 - t) / t <= 0.005 THEN -1000000 END AS scale FROM (SELECT accession, try_cast(raw AS DOUBLE) AS v, try_cast(truth AS DOUBLE) AS t FROM {ANSWERS}) x"),
    "source_kind": (source_kind, f"SELECT accession, field, CASE WHEN bool_or(chunk_type = 'table') THEN 'table' WHEN count(chunk_type) > 0 THEN 'prose' ELSE 'unknown' END AS kind FROM (SELECT *, unnest(string_split(cited, ',')) AS cid FROM {CITED}) x LEFT JOIN {CHUNKS} ON chunk_id = cid GROUP BY 1, 2"),
    "accuracy_by_source_kind": (accuracy_by_source_kind, f"SELECT kind, count(*) AS total, sum((verdict IN ('exact','within_tolerance'))::INT)::BIGINT AS correct FROM (SELECT accession, field, verdict, CASE WHEN bool_or(chunk_type = 'table') THEN 'table' WHEN count(chunk_type) > 0 THEN 'prose' ELSE 'unknown' END AS kind FROM (SELECT *, unnest(string_split(cited, ',')) AS cid FROM {CITED}) x LEFT JOIN {CHUNKS} ON chunk_id = cid GROUP BY 1, 2, 3) y GROUP BY kind"),
    "parse_completion": (parse_completion, f"SELECT id, k % 4 <> 2 AS ok, CASE WHEN k % 4 = 0 THEN k + 0.5E0 END AS total_revenue, CASE WHEN k % 4 = 3 THEN k * 1.0E0 END AS net_income, CASE WHEN k % 4 = 3 THEN 2021 ELSE 2023 END AS fiscal_year, 'USD' AS currency, CASE WHEN k % 4 = 0 THEN 0.9E0 ELSE 0E0 END AS confidence, CASE k % 4 WHEN 0 THEN 'net_income' WHEN 2 THEN 'total_revenue,net_income,total_assets,operating_cash_flow' ELSE '' END AS abstained FROM {COMPLETIONS}"),
    "abstain_fallback": (abstain_fallback, f"SELECT id, a OR b AS ok, CASE WHEN a OR again IS NULL THEN 1 ELSE 2 END AS attempts, {_FIGURE.format('total_revenue')} AS total_revenue, {_FIGURE.format('net_income')} AS net_income, coalesce({_FIGURE.format('confidence')}, 0) AS confidence, CASE WHEN a OR b THEN '' ELSE 'total_revenue,net_income,total_assets,operating_cash_flow' END AS abstained FROM (SELECT *, {_OBJECT.format('reply')} AS a, {_OBJECT.format('again')} AS b FROM {ASKED}) x"),
    "scan_labelled_queries": (scan_labelled_queries, "SELECT CAST(item_id AS VARCHAR) AS id, text AS query, 'Customer#' || lpad(CAST(item_id * 7 AS VARCHAR), 9, '0') AS ticker, CASE WHEN item_id % 2 = 0 THEN '10-K' ELSE '10-Q' END AS form, '1,7' AS items, coalesce(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), '') AS cik FROM benchmark LEFT JOIN customer ON c_name = 'Customer#' || lpad(CAST(item_id * 7 AS VARCHAR), 9, '0')"),
    "scan_tag_map": (scan_tag_map, _TAG_MAPS),
    "value_forms_contains": (value_forms_contains, f"SELECT accession, field, found FROM {_FOUND}"),
    "context_coverage": (context_coverage, f"SELECT field, count(*) FILTER (WHERE truth IS NOT NULL AND found) AS covered, count(*) FILTER (WHERE truth IS NOT NULL AND NOT found) AS missing, count(*) FILTER (WHERE truth IS NULL) AS unresolvable FROM {_FOUND} GROUP BY field"),
    "budget_sweep": (budget_sweep, f"SELECT budget, avg(covered::INT) AS coverage, list_sort(list(tokens))[CAST(floor(count(*) / 2) AS INT) + 1] AS mid, max(tokens) AS most, max(tokens) + 1500 < 4000 AS fits FROM {SIZES} GROUP BY budget"),
    "resolution_probe": (resolution_probe, f"SELECT p.fy, p.field, count(p.tag) AS resolved, count(*) - count(p.tag) AS failed, sum(restated::INT)::BIGINT AS restated, coalesce(max(t.tags), '') AS top_tags, count(p.tag) / count(*) >= 0.7 AS passed FROM {PROBED} LEFT JOIN (SELECT fy, field, string_agg(tag, ',' ORDER BY rk) AS tags FROM (SELECT fy, field, tag, row_number() OVER (PARTITION BY fy, field ORDER BY count(*) DESC, tag) AS rk FROM {PROBED} WHERE tag IS NOT NULL GROUP BY 1, 2, 3) x WHERE rk <= 4 GROUP BY 1, 2) t ON t.fy = p.fy AND t.field = p.field GROUP BY 1, 2"),
    "relevance_ceiling": (relevance_ceiling, "SELECT round(avg(c), 6) AS ceiling, sum((c < 1)::INT)::BIGINT AS under FROM (SELECT least(sum((event_type = 'error')::INT), 10) / 10.0E0 AS c FROM events GROUP BY user_id) x"),
    "table_layout_flag": (table_layout_flag, _LAYOUT),
    "slo_burn_fast": (slo_burn(3600), _burn_sql(3600)),
    "slo_burn_slow": (slo_burn(21600), _burn_sql(21600)),
    "histogram_quantile": (histogram_quantile, f"SELECT b.route, round(CASE WHEN max(t.tot) > 0 THEN min(low + (le - low) * (0.95E0 * tot - bf) / (n - bf)) FILTER (WHERE n >= 0.95E0 * tot AND bf < 0.95E0 * tot) END, 9) AS value FROM (SELECT *, coalesce(lag(le) OVER (PARTITION BY route ORDER BY le), 0) AS low, coalesce(lag(n) OVER (PARTITION BY route ORDER BY le), 0) AS bf FROM {BUCKETS}) b JOIN (SELECT route, max(n) AS tot FROM {BUCKETS} GROUP BY route) t ON t.route = b.route GROUP BY b.route"),
    "alert_for_duration": (alert_for_duration, _HELD),
    "alert_inhibition": (alert_inhibition, _INHIBITED),
    "cover_density_rank": (cover_density_rank, _COVER),
    "web_search_filter": (web_search_filter, f"SELECT doc_id FROM {_TOKENS} WHERE list_has_any(tokens, ['the', 'idiot']) AND NOT list_contains(tokens, 'licensed') AND contains(' ' || array_to_string(tokens, ' ') || ' ', ' of the ')"),
    "hive_prefix": (hive_prefix, "SELECT doc_id, 'source=' || source || '/lang=' || lang || '-xy' AS prefix FROM documents"),
}
