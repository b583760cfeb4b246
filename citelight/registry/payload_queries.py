"""Payload flatteners.

Each table row becomes one payload document (JSON text), built in place without any
grouping; the flatteners then parse and flatten the documents of the whole table.
The SQL selects the rows directly from the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.latest import latest_per_key
from ..operators.lookup import normalise_names
from ..plans.quality import capped_pages, failed_units
from ..plans.reports import mean_sentiment
from ..sources import flatten
from ..sources.payloads import parse_payloads, split_corrupt
from ..sources.tables import stringify_nested
from .base import Tables, query


def _document(**data: Column) -> Column:
    """``{"data": {...}}`` as JSON text; NULL fields are left out."""
    return F.to_json(F.struct(F.struct(*[c.alias(name) for name, c in data.items()]).alias("data")))


def _object(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def _payloads(rows: DataFrame, schema: StructType) -> DataFrame:
    return split_corrupt(parse_payloads(rows, schema))[0]


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _iso(name: str) -> Column:
    """A timestamp as ISO-8601 text with ``Z``."""
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _when(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


# --- brands, terms, topics ----------------------------------------------------------------


def _brand_payloads(t: Tables) -> DataFrame:
    added = F.array(
        _object(searchTermId=_text("c_nationkey"), query=F.col("c_name"), addedAt=F.lit("2026-01-01T00:00:00Z")),
        _object(searchTermId=_text("c_nationkey"), query=F.col("c_mktsegment"), addedAt=F.lit("2026-02-01T00:00:00Z")),
    )
    brand = _object(
        id=_text("c_custkey"), name=F.col("c_name"),
        url=_when(F.col("c_acctbal") >= 0, F.concat(F.lit("https://"), F.lower("c_mktsegment"))),
        operationalSearchTerms=added,
    )
    return _payloads(t.customer.select(_document(brands=F.array(brand)).alias("payload")), schemas.BRANDS)


@query("""SELECT c_custkey::VARCHAR AS brand_id, c_name AS name,
  CASE WHEN c_acctbal >= 0 THEN 'https://' || lower(c_mktsegment) END AS domain, true AS is_own_brand FROM customer""")
def flatten_brands(t: Tables) -> DataFrame:
    return flatten.brands(_brand_payloads(t))


@query("""SELECT c_nationkey::VARCHAR AS search_term_id, max(c_mktsegment) AS query,
  TIMESTAMP '2026-02-01 00:00:00' AS added_at FROM customer GROUP BY ALL""")
def embedded_terms_latest(t: Tables) -> DataFrame:
    """Search terms embedded in brand payloads: repeated ids reduced to the newest."""
    terms = flatten.embedded_terms(_brand_payloads(t)).drop("brand_id")
    return latest_per_key(terms, ["search_term_id"], [F.desc_nulls_last("added_at")])


def _term_payloads(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    no_text = F.array().cast("array<string>")
    term = _object(
        id=_text("o_orderkey"), term=F.concat(F.lit("prompt "), _text("o_custkey")),
        aiSearchEngines=F.when(status == "F", no_text).otherwise(
            F.array(F.col("o_orderpriority"), F.lit("second"))),
        status=F.when(status == "O", F.lit("active")).otherwise(F.lit("paused")),
        executionsAmount=F.col("o_custkey"), interval=F.lit("weekly"), region=F.lit("cz"),
        createdAt=_iso("o_orderdate"), lastExecutionTime=_when(status != "P", _iso("o_orderdate")),
        nextScheduledExecutionTime=F.when(status == "F", F.lit("not a time")).otherwise(_iso("o_orderdate")),
        searchTermTopicRef=_when(status != "P", _object(id=status, name=F.concat(F.lit("Topic "), status))),
        tags=F.when(status == "O", F.array(F.lit("a b"), F.col("o_orderpriority"))).when(status == "F", no_text),
    )
    rows = t.orders.select(
        F.concat(F.lit("ws-"), status).alias("brand_id"), _document(searchTerms=F.array(term)).alias("payload")
    )
    return _payloads(rows, schemas.SEARCH_TERMS)


TERM_ROWS = """SELECT 'ws-' || o_orderstatus AS brand_id, o_orderkey::VARCHAR AS search_term_id,
  'prompt ' || o_custkey::VARCHAR AS query, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS engine,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS topic_id,
  CASE WHEN o_orderstatus <> 'P' THEN 'Topic ' || o_orderstatus END AS topic_name, 'cz' AS region,
  'weekly' AS "interval", CASE WHEN o_orderstatus = 'O' THEN '["a b", "' || o_orderpriority || '"]' ELSE '[]' END AS tags,
  CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'paused' END AS status, o_orderdate AS created_at,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS last_execution_time,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS next_execution_time, o_custkey AS executions_amount FROM orders"""


@query(TERM_ROWS)
def flatten_terms(t: Tables) -> DataFrame:
    return flatten.search_terms(_term_payloads(t))


@query(f"SELECT brand_id, count(*) AS rows FROM ({TERM_ROWS}) GROUP BY ALL HAVING count(*) >= 5000")
def capped_term_pages(t: Tables) -> DataFrame:
    """Brands whose list of search terms is as long as a page."""
    return capped_pages(flatten.search_terms(_term_payloads(t)))


@query("""SELECT p_brand AS brand_id, p_partkey::VARCHAR AS topic_id, p_name AS topic_name,
  len(string_split(p_name, ' '))::BIGINT AS terms, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(p_partkey)
  + INTERVAL 580 MILLISECOND AS created_at FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')""")
def flatten_topics(t: Tables) -> DataFrame:
    """Topics with search terms; topics with an empty or a missing list are dropped."""
    listed = (
        F.when(F.col("p_type") == "PROMO", F.array().cast("array<string>"))
        .when(F.col("p_type") != "SMALL", F.split("p_name", " "))
    )
    topic = _object(
        id=_text("p_partkey"), name=F.col("p_name"), searchTermIds=listed,
        createdAt=_object(_seconds=F.col("p_partkey"), _nanoseconds=F.lit(580000000)),
    )
    rows = t.part.select(F.col("p_brand").alias("brand_id"), _document(topics=F.array(topic)).alias("payload"))
    return flatten.active_topics(_payloads(rows, schemas.TOPICS)).select(
        "brand_id", "topic_id", "topic_name", F.size("search_term_ids").cast("bigint").alias("terms"), "created_at"
    )


# --- search-term report -------------------------------------------------------------------


def _report_payloads(t: Tables, schema: StructType) -> DataFrame:
    """One term per line item: own brand for flag R, two competitors unless flag N, one of them with variations."""
    flag = F.col("l_returnflag")

    def brand(name: Column, score: Column, **more: Column) -> Column:
        return _object(
            name=name, visibilityScore=score, avgSentiment=F.col("l_quantity"), avgRank=F.col("l_tax"),
            latestRank=F.col("l_linenumber").cast("bigint"), detectionRate=F.col("l_discount"), top3=F.lit(50.0),
            citationCount=F.col("l_suppkey"), appearances=F.col("l_partkey"), **more,
        )

    no_variants = F.array().cast(schemas.TERM_REPORT["data"].dataType["searchTerms"].dataType.elementType[
        "ownBrand"].dataType["variations"].dataType)
    variants = F.array(brand(F.lit("Rvl"), F.lit(1.5)), brand(F.lit("RIVAL"), F.lit(2.5)))
    term = _object(
        searchTermId=_text("l_orderkey"), aiSearchEngines=F.array(F.col("l_linestatus")),
        topic=_when(flag != "A", _object(id=flag, name=F.concat(F.lit("Topic "), flag))),
        lastSnapshotAt=_when(F.col("l_tax") > 0, _iso("l_shipdate")),
        ownBrand=_when(flag == "R", brand(F.lit(""), F.col("l_extendedprice"), variations=no_variants)),
        competitors=_when(flag != "N", F.array(
            brand(F.lit("Rival"), F.col("l_extendedprice") + 1, variations=variants),
            brand(F.concat(F.lit("Other "), _text("l_suppkey")), F.lit(0.0), variations=no_variants),
        )),
    )
    rows = t.lineitem.select(
        F.concat(F.lit("ws-"), F.col("l_linestatus")).alias("brand_id"),
        _document(searchTerms=F.array(term)).alias("payload"),
    )
    return _payloads(rows, schema)


LINE_BRANDS = """line_brands AS (
  SELECT *, '' AS name, true AS own, l_extendedprice AS score FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT *, 'Rival', false, l_extendedprice + 1 FROM lineitem WHERE l_returnflag <> 'N'
  UNION ALL SELECT *, 'Other ' || l_suppkey::VARCHAR, false, 0 FROM lineitem WHERE l_returnflag <> 'N')"""
LINE_MEASURES = """l_quantity AS avg_sentiment, l_tax AS avg_rank, l_linenumber::BIGINT AS latest_rank,
  l_discount AS detection_rate, 50::DOUBLE AS top3_rate, l_suppkey AS citation_count, l_partkey AS appearances"""


@query(f"""WITH {LINE_BRANDS} SELECT 'ws-' || l_linestatus AS brand_id, l_orderkey::VARCHAR AS search_term_id,
  l_linestatus AS engine, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS topic_id,
  CASE WHEN l_returnflag <> 'A' THEN 'Topic ' || l_returnflag END AS topic_name,
  CASE WHEN l_tax > 0 THEN l_shipdate END AS last_snapshot_at, name AS brand_name, own AS is_own_brand,
  score AS visibility_score, {LINE_MEASURES} FROM line_brands""")
def flatten_snapshots(t: Tables) -> DataFrame:
    return flatten.brand_snapshots(_report_payloads(t, schemas.SNAPSHOTS))


@query(f"""WITH {LINE_BRANDS} SELECT coalesce(CASE WHEN l_tax > 0 THEN l_shipdate END, DATE '2026-01-02')::DATE
    AS snapshot_date, strftime(coalesce(CASE WHEN l_tax > 0 THEN l_shipdate END, DATE '2026-01-02'), '%G-%V')
    AS snapshot_week, l_orderkey::VARCHAR AS search_term_id, 'ws-' || l_linestatus AS owning_brand_id,
  CASE WHEN name = '' THEN 'unknown' ELSE name END AS brand_name, own AS is_own_brand,
  CASE WHEN own THEN 'ws-' || l_linestatus END AS brand_id, score AS visibility_score, {LINE_MEASURES},
  l_linestatus AS engine, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS topic_id,
  CASE WHEN l_tax > 0 THEN l_shipdate END AS last_snapshot_at FROM line_brands""")
def flatten_dated_snapshots(t: Tables) -> DataFrame:
    """Snapshots for the load-by-date tables: day and week filled in, unnamed brands named."""
    return flatten.dated_brand_snapshots(_report_payloads(t, schemas.SNAPSHOTS), F.lit("2026-01-02").cast("date"))


@query("""SELECT 'ws-' || l_linestatus AS brand_id, max(CASE WHEN l_tax > 0 THEN l_shipdate END) AS payload_max
FROM lineitem GROUP BY ALL""")
def payload_marks(t: Tables) -> DataFrame:
    """Newest snapshot time in each brand's payloads."""
    return flatten.latest_payload_snapshot(_report_payloads(t, schemas.SNAPSHOT_MARKS))


VARIATIONS = f"""variations AS (SELECT 'ws-' || l_linestatus AS brand_id, l_orderkey::VARCHAR AS search_term_id,
  'Rival' AS brand_name, v.variant, v.score AS visibility_score, {LINE_MEASURES}
  FROM lineitem CROSS JOIN (VALUES ('Rvl', 1.5::DOUBLE), ('RIVAL', 2.5::DOUBLE)) v(variant, score)
  WHERE l_returnflag <> 'N')"""


@query(f"WITH {VARIATIONS} SELECT * FROM variations")
def flatten_variations(t: Tables) -> DataFrame:
    """Spellings listed under each competitor."""
    return flatten.name_variations(_report_payloads(t, schemas.VARIATIONS))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Rival' WHEN 'F' THEN 'Rival' ELSE 'P' END AS brand_name
FROM orders""")
def spelling_lookup(t: Tables) -> DataFrame:
    """Variant to canonical name, as found in the payloads, used to normalise names."""
    spellings = flatten.spelling_map(flatten.name_variations(_report_payloads(t, schemas.VARIATIONS)))
    status = F.col("o_orderstatus")
    found = F.when(status == "O", F.lit("Rvl")).when(status == "F", F.lit("RIVAL")).otherwise(status)
    named = normalise_names(
        t.orders.select("o_orderkey", found.alias("found")), "found",
        spellings.withColumnRenamed("brand_name", "canonical"), "variant", "canonical", "brand_name",
    )
    return named.drop("found")


@query("""SELECT 'ws' AS brand_id, role AS search_term_id, conv_id::VARCHAR || '-' || turn::VARCHAR AS execution_id,
  TIMESTAMP '2026-04-21 06:05:46.608' AS executed_at, role AS engine, text AS answer_text
FROM conversations WHERE role <> 'system'""")
def flatten_answers(t: Tables) -> DataFrame:
    """Whole answer texts; a missing list gives no rows."""
    answer = _object(
        executionId=F.concat_ws("-", _text("conv_id"), _text("turn")),
        executedAt=F.lit("2026-04-21T06:05:46.608Z"), engine=F.col("role"), answerText=F.col("text"),
    )
    term = _object(
        searchTermId=F.col("role"), answerTexts=_when(F.col("role") != "system", F.array(answer))
    )
    rows = t.conversations.select(F.lit("ws").alias("brand_id"), _document(searchTerms=F.array(term)).alias("payload"))
    return flatten.answer_texts(_payloads(rows, schemas.ANSWERS))


# --- citations ----------------------------------------------------------------------------


def _citation_payloads(t: Tables, schema: StructType) -> DataFrame:
    """Per line item one query with two domains: one with two URLs, one that has only its own count."""

    def domain(name: Column, count: Column, urls: Column) -> Column:
        return _object(domain=name, occurrences=count, urls=urls)

    def url(path: str, count: Column) -> Column:
        return _object(url=F.concat(F.lit("https://"), _text("l_suppkey"), F.lit(path)), occurrences=count)

    quantity = F.col("l_quantity").cast("bigint")
    urls = F.array(url("/a", quantity), url("/b", F.lit(None).cast("bigint")))
    no_urls = F.array().cast(urls_type())
    domains = F.array(
        domain(_text("l_suppkey"), quantity * 2, urls),
        domain(F.lit("bare.example"), _when(F.col("l_tax") > 0, F.col("l_partkey")), no_urls),
    )
    per_query = _object(
        query=_when(F.col("l_returnflag") != "A", F.concat(F.lit("prompt "), _text("l_partkey"))),
        searchTermIds=F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(
            F.array(_text("l_orderkey"), F.lit("second"))),
        engines=F.array(_object(engineId=F.col("l_linestatus"), domains=domains)),
    )
    summary = _object(
        topDomainsOverall=domains, topDomainsByQuery=F.array(per_query),
        topDomainsByCompetitor=F.array(_object(brandName=F.col("l_returnflag"), occurrences=quantity, domains=domains)),
    )
    page = _object(
        returnedCount=quantity, totalCount=F.col("l_partkey"), citationsCapped=F.col("l_quantity") > 45,
        brandsCapped=F.lit(False), maxCitations=F.lit(5000), maxBrands=F.lit(50),
    )
    rows = t.lineitem.select(
        F.concat(F.lit("ws-"), F.col("l_linestatus")).alias("brand_id"),
        _document(domainSummary=summary, paginationInfo=page).alias("payload"),
    )
    return _payloads(rows, schema)


def urls_type():
    """Type of a domain's URL list."""
    summary = schemas.CITATIONS["data"].dataType["domainSummary"].dataType
    return summary["topDomainsOverall"].dataType.elementType["urls"].dataType


CITED = """cited AS (
  SELECT *, l_suppkey::VARCHAR AS domain, 'https://' || l_suppkey::VARCHAR || '/a' AS url, l_quantity::BIGINT AS n
    FROM lineitem
  UNION ALL SELECT *, l_suppkey::VARCHAR, 'https://' || l_suppkey::VARCHAR || '/b', 0 FROM lineitem
  UNION ALL SELECT *, 'bare.example', NULL, CASE WHEN l_tax > 0 THEN l_partkey ELSE 0 END FROM lineitem)"""


@query(f"""WITH {CITED} SELECT 'ws-' || l_linestatus AS brand_id,
  CASE WHEN l_returnflag <> 'N' THEN l_orderkey::VARCHAR END AS search_term_id,
  CASE WHEN l_returnflag <> 'A' THEN 'prompt ' || l_partkey::VARCHAR ELSE '' END AS query, l_linestatus AS engine,
  domain, url, n AS occurrences FROM cited""")
def flatten_citations(t: Tables) -> DataFrame:
    return flatten.citations(_citation_payloads(t, schemas.CITED_URLS))


@query("""WITH d AS (
  SELECT *, l_suppkey::VARCHAR AS domain, l_quantity::BIGINT * 2 AS n, 2 AS url_count FROM lineitem
  UNION ALL SELECT *, 'bare.example', CASE WHEN l_tax > 0 THEN l_partkey END, 0 FROM lineitem)
SELECT 'ws-' || l_linestatus AS brand_id, 'overall' AS scope, NULL::VARCHAR AS member, domain, n AS occurrences,
  url_count FROM d
UNION ALL SELECT 'ws-' || l_linestatus, 'competitor', l_returnflag, domain, n, url_count FROM d""")
def flatten_domain_rollups(t: Tables) -> DataFrame:
    """The payload's own top-domain lists."""
    return flatten.domain_rollups(_citation_payloads(t, schemas.DOMAIN_ROLLUPS))


@query("""SELECT 'ws-' || l_linestatus AS brand_id, l_quantity::BIGINT AS returned_count, l_partkey AS total_count,
  5000::BIGINT AS max_citations, 50::BIGINT AS max_brands FROM lineitem WHERE l_quantity > 45""")
def capped_citations(t: Tables) -> DataFrame:
    """Citation payloads the sender cut."""
    return flatten.capped_citations(_citation_payloads(t, schemas.CITATION_PAGES))


# --- report timelines ---------------------------------------------------------------------


def _timeline_payloads(t: Tables, schema: StructType) -> DataFrame:
    """Per event a two-point timeline: in which period depends on the event type; some series are short."""
    later = F.date_format(F.col("ts") + F.expr("interval 7 days"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    stamps = F.array(_iso("ts"), later)
    value = F.col("value")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    series = _object(
        timestamps=stamps, visibilityScore=F.array(value, value + 1), mentions=F.array(k),
        sentiment=F.array(value), detectionRate=F.array(value, value),
        brandNotFound=F.array(F.col("event_type") == "view", F.lit(False)),
    )
    empty = _object(timestamps=F.array().cast("array<string>"))
    none = F.lit(None).cast("array<double>")
    kind = F.col("event_type")
    periods = _object(
        weekly=F.when(kind != "click", F.to_json(series)).otherwise(F.to_json(empty)),
        daily=_when(kind == "click", F.to_json(series)),
    )
    # Period objects differ in their fields, so they are put together as text.
    own = F.concat(
        F.lit('{"name":'), F.to_json(F.array(kind)).substr(F.lit(2), F.length(kind) + 2),
        F.lit(',"historicalData":{"weekly":'), periods["weekly"],
        F.coalesce(F.concat(F.lit(',"daily":'), periods["daily"]), F.lit("")),
        F.lit('},"engineMetricsData":{"weekly":[],"daily":[{"engineId":"e1","engineName":"Engine 1",'),
        F.to_json(series).substr(F.lit(2), F.length(F.to_json(series))),
        F.lit("]}}"),
    )
    rivals = F.to_json(_object(
        weekly=_object(
            timestamps=stamps,
            competitors=F.array(
                _object(name=F.lit("Rival"), isOwnBrand=F.lit(None).cast("boolean"), metrics=_object(
                    visibilityScore=F.array(value * 2), citations=F.array(k, k), avgPosition=F.array(value),
                    top3=F.array(value, value))),
                _object(name=F.lit(None).cast("string"), isOwnBrand=F.lit(True), metrics=_object(
                    visibilityScore=F.array(value), citations=F.array(k), avgPosition=none, top3=none)),
            ),
        ),
    ))
    summary = F.to_json(F.array(_object(
        name=kind, isOwnBrand=F.lit(True), latestValue=value, trend=F.lit(0.5), latestRank=F.lit(4.5),
        visibilityScore=value, appearances=k,
    )))
    payload = F.concat(
        F.lit('{"data":{"ownBrandMetrics":'), own, F.lit(',"competitorMetrics":'), summary,
        F.lit(',"competitorTimeSeriesData":'), rivals, F.lit("}}"),
    )
    rows = t.events.select(
        _text("user_id").alias("brand_id"), F.lit("Owner").alias("brand_name"),
        _text("event_id").alias("topic_id"), F.concat(F.lit("Topic "), _text("event_id")).alias("topic_name"),
        payload.alias("payload"),
    )
    return _payloads(rows, schema)


POINTS = """points AS (
  SELECT e.*, p.pos, e.ts + to_days(7 * p.pos) AS moment, s.name, s.own, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k
  FROM events e CROSS JOIN (VALUES (0), (1)) p(pos)
  CROSS JOIN (VALUES ('own', true), ('Rival', false), (NULL, true)) s(name, own))"""


@query(f"""WITH {POINTS} SELECT md5(user_id::VARCHAR || '|' || event_id::VARCHAR || '|' ||
    coalesce(CASE name WHEN 'own' THEN event_type ELSE name END, 'None') || '|' || strftime(moment, '%Y-%m-%d'))
    AS business_key, user_id::VARCHAR AS owning_brand_id, event_id::VARCHAR AS topic_id,
  'Topic ' || event_id::VARCHAR AS topic_name, moment AS snapshot_time, moment::DATE AS snapshot_date,
  CASE name WHEN 'own' THEN event_type ELSE name END AS brand_name, own AS is_own_brand,
  CASE WHEN name = 'own' THEN value + pos WHEN pos = 0 AND name = 'Rival' THEN value * 2 WHEN pos = 0 THEN value END
    AS visibility_score, CASE WHEN name = 'own' AND pos = 0 THEN value END AS sentiment,
  CASE WHEN name = 'Rival' AND pos = 0 THEN value END AS avg_position,
  CASE WHEN name = 'own' THEN value END AS detection_rate, CASE WHEN name = 'Rival' THEN value END AS top3, CASE WHEN name = 'own' AND pos = 0 THEN k END AS mentions,
  CASE WHEN name = 'Rival' OR (name IS NULL AND pos = 0) THEN k END AS citations
FROM points""")
def flatten_report(t: Tables) -> DataFrame:
    """Own and competitor timelines; the random row id is left out."""
    return flatten.report_rows(_timeline_payloads(t, schemas.TIMELINES)).drop("unique_row_id")


@query(f"""WITH {POINTS} SELECT user_id::VARCHAR AS owning_brand_id, 'e1' AS member_id, 'Engine 1' AS member_name,
  value + pos AS visibility_score, CASE WHEN pos = 0 THEN k END AS mentions,
  CASE WHEN pos = 0 THEN event_type = 'view' ELSE false END AS brand_not_found, moment AS snapshot_time,
  moment::DATE AS snapshot_date FROM points WHERE name = 'own'""")
def flatten_breakdown(t: Tables) -> DataFrame:
    """Own timelines per engine."""
    return flatten.breakdown_rows(_timeline_payloads(t, schemas.BREAKDOWNS["engine"]), "engine").select(
        "owning_brand_id", "member_id", "member_name", "visibility_score", "mentions", "brand_not_found",
        "snapshot_time", "snapshot_date",
    )


@query(f"""WITH {POINTS} SELECT user_id::VARCHAR AS owning_brand_id, moment::DATE AS snapshot_date,
  bool_or(pos = 0 AND event_type = 'view') AS brand_not_found FROM points WHERE name = 'own' GROUP BY ALL""")
def brand_gaps(t: Tables) -> DataFrame:
    """Days on which some snapshot missed the brand."""
    return flatten.brand_gaps(_timeline_payloads(t, schemas.BRAND_GAPS))


@query("""SELECT user_id::VARCHAR AS owning_brand_id, event_type AS brand_name, true AS is_own_brand,
  value AS latest_value, 0.5::DOUBLE AS trend, 4.5::DOUBLE AS latest_rank, value AS visibility_score,
  regexp_extract(props, '([0-9]+)', 1)::BIGINT AS appearances FROM events""")
def competitor_summary(t: Tables) -> DataFrame:
    """Summary of all brands of a report."""
    return flatten.competitor_summary(_timeline_payloads(t, schemas.COMPETITORS)).select(
        "owning_brand_id", "brand_name", "is_own_brand", "latest_value", "trend", "latest_rank", "visibility_score",
        "appearances",
    )


# --- sentiment ----------------------------------------------------------------------------


def _sentiment_payloads(t: Tables) -> DataFrame:
    """Per document keyword maps keyed by its source and language."""

    def details(count: int) -> Column:
        return _object(
            count=F.lit(count), executionIds=F.array(_text("doc_id"), _text("n_chars")),
            timestamps=F.array(F.lit("2026-05-19T06:08:02Z"), F.lit("2026-05-19T06:08:46Z")),
        )

    words = F.create_map(F.col("source"), details(2))
    bad = F.create_map(F.concat(F.lit("not "), F.col("lang")), details(1))
    engine = F.create_map(F.lit("engine_1"), _object(sum=F.col("n_chars"), count=F.lit(2), avg=F.lit(1.0)))
    brand = _object(
        name=F.col("lang"), isOwnBrand=F.col("lang") == "en", totalSentimentScore=F.col("n_chars"),
        sentimentCount=F.lit(3), positiveKeywords=words, negativeKeywords=bad,
        webGroundingKeywords=_object(positive=words, byEngine=F.create_map(F.lit("engine_1"), _object(neutral=bad))),
        webGroundingSentimentByEngine=engine,
    )
    rows = t.documents.select(
        F.concat(F.lit("ws-"), F.col("lang")).alias("brand_id"), _document(brandSentiments=F.array(brand)).alias("payload")
    )
    return _payloads(rows, schemas.SENTIMENT)


KEYWORDS = """keywords AS (
  SELECT 'ws-' || lang AS owning_brand_id, lang AS brand_name, s.source, s.engine, s.polarity,
    CASE WHEN s.bad THEN 'not ' || lang ELSE d.source END AS keyword,
    CASE WHEN s.bad THEN 1 ELSE 2 END::BIGINT AS count, doc_id, n_chars
  FROM documents d CROSS JOIN (VALUES ('all', NULL, 'positive', false), ('all', NULL, 'negative', true),
    ('web', NULL, 'positive', false), ('web', 'engine_1', 'neutral', true)) s(source, engine, polarity, bad))"""


@query(f"""WITH {KEYWORDS} SELECT owning_brand_id, brand_name, source, engine, polarity, keyword, count,
  doc_id::VARCHAR AS execution_id, TIMESTAMP '2026-05-19 06:08:02' AS at FROM keywords
UNION ALL SELECT owning_brand_id, brand_name, source, engine, polarity, keyword, count, n_chars::VARCHAR,
  TIMESTAMP '2026-05-19 06:08:46' FROM keywords""")
def flatten_keywords(t: Tables) -> DataFrame:
    """Sentiment keywords with the execution and time of each occurrence."""
    return flatten.keyword_occurrences(flatten.sentiment_keywords(_sentiment_payloads(t)))


@query("""SELECT lang AS brand_name, 'engine_1' AS engine, sum(n_chars)::BIGINT::DOUBLE / nullif(sum(2), 0)::BIGINT
  AS mean_sentiment FROM documents GROUP BY ALL""")
def engine_sentiment(t: Tables) -> DataFrame:
    """Mean sentiment per brand and engine."""
    return mean_sentiment(flatten.engine_sentiment(_sentiment_payloads(t)), ["brand_name", "engine"])


@query("""SELECT lang AS brand_name, lang = 'en' AS is_own_brand, sum(n_chars)::BIGINT::DOUBLE / nullif(sum(3), 0)::BIGINT
  AS mean_sentiment FROM documents GROUP BY ALL""")
def brand_sentiment(t: Tables) -> DataFrame:
    """Mean sentiment per brand over all engines."""
    return mean_sentiment(flatten.sentiment_totals(_sentiment_payloads(t)), ["brand_name", "is_own_brand"])


# --- failures, nested values --------------------------------------------------------------


@query("SELECT o_orderstatus AS brand_id, count(*) AS payloads FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY ALL")
def quarantine(t: Tables) -> DataFrame:
    """Unreadable payloads are set apart and counted per brand; the others stay usable."""
    good = _document(searchTerms=F.array(_object(id=_text("o_orderkey"))))
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.substring(good, 1, 30)).otherwise(good)
    rows = t.orders.select(F.col("o_orderstatus").alias("brand_id"), text.alias("payload"))
    _, bad = split_corrupt(parse_payloads(rows, schemas.SEARCH_TERMS))
    return failed_units(bad)


@query("""SELECT p_partkey, '["' || replace(p_name, ' ', '","') || '"]' AS words,
  '{"brand":"' || p_brand || '","size":' || p_size::VARCHAR || '}' AS facts FROM part""")
def nested_as_text(t: Tables) -> DataFrame:
    """Arrays and structs stored as JSON text."""
    nested = t.part.select(
        "p_partkey", F.split("p_name", " ").alias("words"),
        _object(brand=F.col("p_brand"), size=F.col("p_size")).alias("facts"),
    )
    return stringify_nested(nested)
