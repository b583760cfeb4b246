"""The star-schema tables seen as AI-visibility data.

events: one row is one load of a snapshot; ``user_id`` is the search term,
``event_type`` the brand, ``purchase`` the own brand, ``value`` the visibility and the
number in ``props`` the source of the other measures. orders: one row is one load of
a search term. lineitem: citations, and metrics of the run ``l_orderkey``.

Each binding is given twice, as DataFrame and as the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import business_key
from ..operators.eav import entity_type
from .base import Tables


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _owner(name: str) -> Column:
    return F.concat(F.lit("ws-"), F.length(_text(name)).cast("string"))


# --- snapshots ----------------------------------------------------------------------------

SNAP_MEASURES = (
    "visibility_score", "avg_sentiment", "avg_rank", "latest_rank", "detection_rate", "top3_rate",
    "citation_count", "appearances",
)


def snapshots(t: Tables) -> DataFrame:
    """events as rows of the snapshot landing table; one-digit numbers have no snapshot time."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    last = F.substring(k, -1, 1)
    first = F.substring(k, 1, 1)
    return t.events.select(
        _owner("user_id").alias("brand_id"),
        _text("user_id").alias("search_term_id"),
        F.concat(F.lit("engine_"), first).alias("engine"),
        F.concat(F.lit("topic_"), last).alias("topic_id"),
        F.concat(F.lit("Topic "), last).alias("topic_name"),
        F.when(F.length(k) > 1, F.col("ts")).alias("last_snapshot_at"),
        F.col("event_type").alias("brand_name"),
        (F.col("event_type") == "purchase").alias("is_own_brand"),
        F.col("value").alias("visibility_score"),
        k.cast("double").alias("avg_sentiment"),
        F.when(F.length(k) > 1, first.cast("double")).alias("avg_rank"),
        first.cast("bigint").alias("latest_rank"),
        k.cast("double").alias("detection_rate"),
        (last.cast("double") * 10.0).alias("top3_rate"),
        k.cast("bigint").alias("citation_count"),
        last.cast("bigint").alias("appearances"),
        (F.date_trunc("day", F.col("ts")) + F.expr("interval 30 hours")).cast("timestamp_ntz").alias("etl_loaded_at"),
    )


SNAP = """snap AS (
  SELECT 'ws-' || length(user_id::VARCHAR)::VARCHAR AS brand_id, user_id::VARCHAR AS search_term_id,
    'engine_' || k[1:1] AS engine, 'topic_' || k[-1:] AS topic_id, 'Topic ' || k[-1:] AS topic_name,
    CASE WHEN length(k) > 1 THEN ts END AS last_snapshot_at, event_type AS brand_name,
    event_type = 'purchase' AS is_own_brand, value AS visibility_score, k::DOUBLE AS avg_sentiment,
    CASE WHEN length(k) > 1 THEN k[1:1]::DOUBLE END AS avg_rank, k[1:1]::BIGINT AS latest_rank,
    k::DOUBLE AS detection_rate, k[-1:]::DOUBLE * 10 AS top3_rate, k::BIGINT AS citation_count,
    k[-1:]::BIGINT AS appearances, date_trunc('day', ts)::TIMESTAMP + INTERVAL 30 HOUR AS etl_loaded_at
  FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events))"""

SNAP_TIES = """is_own_brand DESC, brand_id DESC, search_term_id DESC, engine DESC, topic_id DESC, topic_name DESC,
      visibility_score DESC, avg_sentiment DESC, avg_rank DESC NULLS LAST, latest_rank DESC, detection_rate DESC,
      top3_rate DESC, citation_count DESC, appearances DESC"""

FACT = f"""dated AS (
  SELECT *, coalesce(last_snapshot_at, etl_loaded_at)::DATE AS snapshot_date,
    strftime(coalesce(last_snapshot_at, etl_loaded_at), '%G-%V') AS snapshot_week FROM snap),
single AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY search_term_id, brand_name, snapshot_week
    ORDER BY last_snapshot_at DESC NULLS LAST, etl_loaded_at DESC, {SNAP_TIES}) AS rn FROM dated) WHERE rn = 1),
fact AS (
  SELECT snapshot_week, snapshot_date, search_term_id, brand_name,
    CASE WHEN is_own_brand THEN brand_id END AS brand_id, is_own_brand, topic_id, engine, visibility_score,
    avg_sentiment, avg_rank, latest_rank, detection_rate, top3_rate, citation_count, appearances,
    visibility_score / nullif((sum(round(visibility_score * 100)::BIGINT)
      OVER (PARTITION BY search_term_id, snapshot_week))::DOUBLE / 1e2, 0) AS ai_share_of_voice
  FROM single)"""

SNAP_FACT = f"{SNAP}, {FACT}"

# --- search terms -------------------------------------------------------------------------


def search_terms(t: Tables) -> DataFrame:
    """orders as rows of the search-term landing table."""
    status = F.col("o_orderstatus")
    tags = (
        F.when(status == "O", F.lit('["open", " hot "]')).when(status == "F", F.lit("[]"))
        .otherwise(F.concat(F.lit('["'), F.col("o_orderpriority"), F.lit('"]')))
    )
    return t.orders.select(
        _owner("o_custkey").alias("brand_id"),
        _text("o_custkey").alias("search_term_id"),
        F.concat(F.lit("prompt "), _text("o_custkey")).alias("query"),
        F.concat(F.lit("engine_"), F.substring("o_orderpriority", 1, 1)).alias("engine"),
        F.concat(F.lit("topic_"), status).alias("topic_id"),
        F.concat(F.lit("Topic "), status).alias("topic_name"),
        F.lower(status).alias("region"),
        F.lit("weekly").alias("interval"),
        tags.alias("tags"),
        F.when(status == "O", F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("last_execution_time"),
        (F.col("o_orderdate") + F.expr("interval 7 days")).alias("next_execution_time"),
        F.col("o_orderkey").alias("executions_amount"),
        F.col("o_orderdate").alias("etl_loaded_at"),
    )


TERMS = """terms AS (
  SELECT 'ws-' || length(o_custkey::VARCHAR)::VARCHAR AS brand_id, o_custkey::VARCHAR AS search_term_id,
    'prompt ' || o_custkey::VARCHAR AS query, 'engine_' || o_orderpriority[1:1] AS engine,
    'topic_' || o_orderstatus AS topic_id, 'Topic ' || o_orderstatus AS topic_name,
    lower(o_orderstatus) AS region, 'weekly' AS "interval",
    CASE o_orderstatus WHEN 'O' THEN '["open", " hot "]' WHEN 'F' THEN '[]'
      ELSE '["' || o_orderpriority || '"]' END AS tags,
    CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'inactive' END AS status, o_orderdate AS created_at,
    o_orderdate AS last_execution_time, o_orderdate + INTERVAL 7 DAY AS next_execution_time,
    o_orderkey AS executions_amount, o_orderdate AS etl_loaded_at
  FROM orders)"""

DIM_TERMS = """dim_terms AS (
  SELECT search_term_id, brand_id, query, engine, topic_id, topic_name, tags, region, "interval",
    status = 'active' AS is_active, created_at, last_execution_time, next_execution_time,
    etl_loaded_at AS updated_at
  FROM (SELECT *, row_number() OVER (PARTITION BY search_term_id ORDER BY etl_loaded_at DESC, brand_id DESC,
    query DESC, engine DESC, topic_id DESC, topic_name DESC, region DESC, "interval" DESC, tags DESC, status DESC,
    created_at DESC, last_execution_time DESC, next_execution_time DESC, executions_amount DESC) AS rn FROM terms)
  WHERE rn = 1)"""

# --- citations ----------------------------------------------------------------------------


def raw_citations(t: Tables) -> DataFrame:
    """events as rows of the citation landing table; some URLs are NULL, some empty."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    last = F.substring(k, -1, 1)
    url = (
        F.when(last == "0", F.lit(None).cast("string")).when(last == "1", F.lit(""))
        .otherwise(F.concat(F.lit("https://www.example.com/"), F.col("event_type")))
    )
    return t.events.select(
        _owner("user_id").alias("brand_id"), _text("user_id").alias("search_term_id"),
        F.concat(F.lit("prompt "), _text("user_id")).alias("query"),
        F.concat(F.lit("engine_"), F.length(k).cast("string")).alias("engine"),
        F.concat(F.col("event_type"), F.lit(".example.com")).alias("domain"),
        url.alias("url"), k.cast("bigint").alias("occurrences"), F.col("ts").alias("etl_loaded_at"),
    )


RAW_CITES = """raw_cites AS (
  SELECT 'ws-' || length(user_id::VARCHAR)::VARCHAR AS brand_id, user_id::VARCHAR AS search_term_id,
    'engine_' || length(k)::VARCHAR AS engine, event_type || '.example.com' AS domain,
    CASE k[-1:] WHEN '0' THEN NULL WHEN '1' THEN '' ELSE 'https://www.example.com/' || event_type END AS url,
    k::BIGINT AS occurrences, ts AS etl_loaded_at
  FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events))"""

FACT_CITES = """fact_cites AS (
  SELECT strftime(etl_loaded_at, '%G-%V') AS snapshot_week, etl_loaded_at::DATE AS snapshot_date,
    search_term_id, brand_id, engine, domain, url, occurrences
  FROM (SELECT *, row_number() OVER (PARTITION BY brand_id, search_term_id, engine, domain, coalesce(url, ''),
    strftime(etl_loaded_at, '%G-%V') ORDER BY etl_loaded_at DESC, url DESC NULLS LAST, occurrences DESC) AS rn
    FROM raw_cites) WHERE rn = 1)"""


def citations(t: Tables) -> DataFrame:
    """lineitem as citation facts."""
    site = F.concat(F.lit("site-"), _text("l_suppkey"), F.lit(".example"))
    return t.lineitem.select(
        _text("l_orderkey").alias("search_term_id"),
        F.concat(F.lit("engine_"), F.col("l_linestatus")).alias("engine"),
        site.alias("domain"),
        F.concat(F.lit("https://"), site, F.lit("/"), _text("l_partkey")).alias("url"),
        F.col("l_quantity").cast("bigint").alias("occurrences"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_returnflag").alias("brand_name"),
    )


CITES = """cites AS (
  SELECT l_orderkey::VARCHAR AS search_term_id, 'engine_' || l_linestatus AS engine,
    'site-' || l_suppkey::VARCHAR || '.example' AS domain,
    'https://site-' || l_suppkey::VARCHAR || '.example/' || l_partkey::VARCHAR AS url,
    l_quantity::BIGINT AS occurrences, l_shipdate::DATE AS snapshot_date, l_returnflag AS brand_name
  FROM lineitem)"""

# --- answers ------------------------------------------------------------------------------


def answers(t: Tables) -> DataFrame:
    """conversations as rows of the answer landing table; each turn is a later load of the same answer."""
    return t.conversations.select(
        F.lit("ws").alias("brand_id"),
        F.concat(F.lit("term-"), F.col("role")).alias("search_term_id"),
        _text("conv_id").alias("execution_id"),
        F.expr("timestampadd(HOUR, conv_id, timestamp_ntz'2024-01-01 00:00:00')").alias("executed_at"),
        F.concat(F.lit("engine_"), F.col("role")).alias("engine"),
        F.col("text").alias("answer_text"),
        F.expr("timestampadd(DAY, turn, timestamp_ntz'2024-03-01 06:00:00')").alias("etl_loaded_at"),
    )


ANSWERS = """raw_answers AS (
  SELECT 'term-' || role AS search_term_id, conv_id::VARCHAR AS execution_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id) AS executed_at, 'engine_' || role AS engine,
    text AS answer_text, TIMESTAMP '2024-03-01 06:00:00' + to_days(turn::INTEGER) AS etl_loaded_at
  FROM conversations),
fact_answers AS (
  SELECT execution_id, search_term_id, strftime(executed_at, '%G-%V') AS snapshot_week, executed_at, engine,
    answer_text
  FROM (SELECT *, row_number() OVER (PARTITION BY execution_id ORDER BY etl_loaded_at DESC, search_term_id DESC,
    executed_at DESC, engine DESC, answer_text DESC) AS rn FROM raw_answers) WHERE rn = 1)"""

# --- report timelines ---------------------------------------------------------------------


def report_rows(t: Tables) -> DataFrame:
    """events as rows of the report landing table."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    topic = F.concat(F.lit("topic_"), F.substring(k, -1, 1))
    day = F.to_date("ts")
    return t.events.select(
        business_key(_owner("user_id"), topic, F.col("event_type"), day).alias("business_key"),
        _owner("user_id").alias("owning_brand_id"), topic.alias("topic_id"), topic.alias("topic_name"),
        day.alias("snapshot_date"), F.col("event_type").alias("brand_name"),
        (F.col("event_type") == "purchase").alias("is_own_brand"), F.col("value").alias("visibility_score"),
        k.cast("bigint").alias("mentions"), F.col("ts").alias("etl_loaded_at"),
    )


REPORT = """report_raw AS (
  SELECT md5(owner || '|' || topic || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d')) AS business_key,
    owner AS owning_brand_id, topic AS topic_id, topic AS topic_name, ts::DATE AS snapshot_date,
    event_type AS brand_name, event_type = 'purchase' AS is_own_brand, value AS visibility_score,
    k::BIGINT AS mentions, ts AS etl_loaded_at
  FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k, 'topic_' || regexp_extract(props, '([0-9]+)', 1)[-1:]
    AS topic, 'ws-' || length(user_id::VARCHAR)::VARCHAR AS owner FROM events)),
report AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY etl_loaded_at DESC,
    visibility_score DESC, mentions DESC) AS rn FROM report_raw) WHERE rn = 1)"""

# --- metric star --------------------------------------------------------------------------

# Metric by line number; lines beyond the list carry citation counts.
LINE_METRICS = ("VISIBILITY", "SENTIMENT", "POSITION_RANK", "DETECTION_RATE", "RECOMMENDATION")


def metrics(t: Tables) -> DataFrame:
    """lineitem as metric rows of the run ``l_orderkey``."""
    kind = F.lit("CITATION_COUNT")
    for line, metric in enumerate(LINE_METRICS, 1):
        kind = F.when(F.col("l_linenumber") == line, F.lit(metric)).otherwise(kind)
    return t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.concat(F.lit("brand_"), F.col("l_returnflag")).alias("brand_name"),
        (F.col("l_returnflag") == "R").alias("is_own_brand"), kind.alias("metric_type"),
        F.col("l_extendedprice").alias("metric_value"),
    )


def runs(t: Tables) -> DataFrame:
    """orders as prompt runs."""
    return t.orders.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("prompt_id"),
        F.col("o_orderpriority").alias("engine_id"),
        F.concat(F.lit("provider_"), F.col("o_orderstatus")).alias("ai_provider"),
        F.col("o_orderpriority").alias("ai_model"), F.col("o_orderdate").alias("executed_at"),
    )


def prompts(t: Tables) -> DataFrame:
    """customer as prompts."""
    return t.customer.select(
        F.col("c_custkey").alias("prompt_id"), F.col("c_name").alias("prompt_text"),
        F.col("c_nationkey").alias("topic_id"), F.col("c_nationkey").alias("brand_id"),
        F.col("c_mktsegment").alias("product"),
        F.when(F.col("c_acctbal") < 0, F.lit("See")).otherwise(F.lit("Think")).alias("funnel"),
        F.lower("c_mktsegment").alias("source"),
    )


def topics(t: Tables) -> DataFrame:
    """nation as topics."""
    return t.nation.select(F.col("n_nationkey").alias("topic_id"), F.col("n_name").alias("topic_name"))


def monitored(t: Tables) -> DataFrame:
    """nation as monitored brands; those of region 0 are own brands."""
    return t.nation.select(
        F.col("n_nationkey").alias("brand_id"), F.col("n_name").alias("monitor_name"),
        entity_type(F.col("n_regionkey") == 0).alias("entity_type"),
    )


STAR = """star AS (
  SELECT l_orderkey AS run_id, 'brand_' || l_returnflag AS brand_name, l_returnflag = 'R' AS is_own_brand,
    CASE l_linenumber WHEN 1 THEN 'VISIBILITY' WHEN 2 THEN 'SENTIMENT' WHEN 3 THEN 'POSITION_RANK'
      WHEN 4 THEN 'DETECTION_RATE' WHEN 5 THEN 'RECOMMENDATION' ELSE 'CITATION_COUNT' END AS metric_type,
    l_extendedprice AS metric_value, o_custkey AS prompt_id, o_orderpriority AS engine_id,
    'provider_' || o_orderstatus AS ai_provider, o_orderpriority AS ai_model, o_orderdate AS executed_at,
    c_name AS prompt_text, c_mktsegment AS product, CASE WHEN c_acctbal < 0 THEN 'See' ELSE 'Think' END AS funnel,
    lower(c_mktsegment) AS source, n_name AS topic_name, n_name AS monitor_name,
    CASE WHEN n_regionkey = 0 THEN 'OWN_BRAND' ELSE 'COMPETITOR' END AS entity_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey)"""


def sql_mean(value: str, condition: str | None = None, places: int | None = None) -> str:
    """SQL of ``mean(value)``, rounded like ``round_to`` when ``places`` is given."""
    if condition:
        value = f"CASE WHEN {condition} THEN {value} END"
    mean = f"(sum(round(({value}) * 100)::BIGINT)::DOUBLE / 1e2 / nullif(count({value}), 0))"
    return mean if places is None else sql_round(mean, places)


def sql_round(value: str, places: int) -> str:
    """SQL of ``round_to``."""
    scale = f"1e{places}"
    return f"(sign({value}) * (floor(abs({value}) * {scale} + 0.5) / {scale}))"
