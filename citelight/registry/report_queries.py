"""Report queries, trends, ranks, the metric star, mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import engine_provider, iso_week, mean, round_to, safe_divide, total, url_domain
from ..operators import eav
from ..operators.mentions import detection_metrics, mention_rank as rank_mentions, mentions
from ..operators.rank import rank_in_group
from ..operators.trend import change_from_previous, moving_average, weekly_values
from ..plans import layers, reports
from ..sources import freshness
from . import bindings as b
from .base import Tables, query

AS_OF = "2024-01-21"


def _as_of():
    return F.lit(AS_OF).cast("date")


def _facts(t: Tables) -> DataFrame:
    """Snapshot facts without share of voice, for the reports that do not show it."""
    return layers.snapshot_columns(layers.latest_snapshots(b.snapshots(t)))


def _shared_facts(t: Tables) -> DataFrame:
    return layers.fact_snapshots(b.snapshots(t))


def _star(t: Tables) -> DataFrame:
    return reports.metric_star(b.metrics(t), b.runs(t), b.prompts(t), b.topics(t), b.monitored(t))


# --- snapshots ----------------------------------------------------------------------------


@query(f"""WITH {b.SNAP_FACT} SELECT snapshot_week, engine, {b.sql_mean('visibility_score')} AS mean_visibility_score,
  {b.sql_mean('avg_rank')} AS mean_avg_rank, {b.sql_mean('detection_rate')} AS mean_detection_rate
FROM fact WHERE is_own_brand GROUP BY ALL""")
def weekly_avg_by_dim(t: Tables) -> DataFrame:
    return reports.weekly_averages(
        _facts(t), ["engine"], ["visibility_score", "avg_rank", "detection_rate"]
    )


@query(f"""WITH {b.SNAP_FACT} SELECT engine, {b.sql_mean('visibility_score')} AS mean_visibility_score,
  {b.sql_mean('avg_sentiment')} AS mean_avg_sentiment
FROM fact WHERE is_own_brand AND snapshot_week = strftime(DATE '{AS_OF}', '%G-%V') GROUP BY ALL""")
def current_week_by_engine(t: Tables) -> DataFrame:
    return reports.current_week_by(
        _facts(t), "engine", _as_of(), ["visibility_score", "avg_sentiment"]
    )


@query(f"""WITH {b.SNAP_FACT} SELECT brand_name, {b.sql_mean('visibility_score')} AS avg_visibility,
  {b.sql_mean('detection_rate')} AS avg_detection
FROM fact WHERE NOT is_own_brand AND snapshot_week = strftime(DATE '{AS_OF}', '%G-%V')
GROUP BY ALL ORDER BY avg_visibility DESC, brand_name LIMIT 10""")
def competitor_top10(t: Tables) -> DataFrame:
    return reports.top_competitors(_facts(t), _as_of())


@query(f"""WITH {b.SNAP_FACT} SELECT snapshot_week, brand_name, is_own_brand, visibility_score, ai_share_of_voice
FROM fact WHERE search_term_id = '17'""")
def prompt_comparison(t: Tables) -> DataFrame:
    return reports.prompt_comparison(_shared_facts(t), "17")


@query(f"""WITH {b.SNAP_FACT} SELECT search_term_id, 'prompt ' || search_term_id AS query, topic_id, visibility_score,
  avg_rank, appearances FROM fact WHERE is_own_brand AND snapshot_date = DATE '2024-01-20'
ORDER BY visibility_score DESC, search_term_id LIMIT 10""")
def top_terms(t: Tables) -> DataFrame:
    facts = _facts(t).withColumn("query", F.concat(F.lit("prompt "), "search_term_id"))
    return reports.top_terms(facts, F.lit("2024-01-20").cast("date"))


@query(f"""WITH {b.SNAP_FACT} SELECT topic_id, {b.sql_mean('visibility_score')} AS avg_visibility,
  count(*) AS term_count FROM fact WHERE snapshot_date = DATE '2024-01-20' GROUP BY ALL""")
def topic_breakdown(t: Tables) -> DataFrame:
    return reports.topic_breakdown(_facts(t), F.lit("2024-01-20").cast("date"))


WEEKLY = f"""weekly AS (SELECT search_term_id, snapshot_week, {b.sql_mean('visibility_score')} AS visibility_score,
  {b.sql_mean('avg_rank')} AS avg_rank FROM fact WHERE is_own_brand GROUP BY ALL),
trends AS (SELECT search_term_id, snapshot_week, visibility_score, avg_rank,
  visibility_score - lag(visibility_score) OVER w AS visibility_score_change,
  avg_rank - lag(avg_rank) OVER w AS avg_rank_change
  FROM weekly WINDOW w AS (PARTITION BY search_term_id ORDER BY snapshot_week))"""


@query(f"""WITH {b.SNAP_FACT}, {WEEKLY} SELECT *,
  CASE WHEN visibility_score_change > 0 THEN 'up' WHEN visibility_score_change < 0 THEN 'down' END
    AS visibility_score_direction,
  CASE WHEN avg_rank_change > 0 THEN 'declined' WHEN avg_rank_change < 0 THEN 'improved' END AS avg_rank_direction
FROM trends""")
def trend_vs_previous(t: Tables) -> DataFrame:
    return reports.term_trends(_facts(t))


@query(f"""WITH {b.SNAP_FACT}, {WEEKLY} SELECT search_term_id, visibility_score, visibility_score_change,
  'up' AS visibility_score_direction FROM trends WHERE snapshot_week = '2024-03' AND visibility_score_change > 0""")
def rising_terms(t: Tables) -> DataFrame:
    return reports.rising_terms(reports.term_trends(_facts(t)), F.lit("2024-03"))


@query("""WITH weekly AS (SELECT l_suppkey, strftime(l_shipdate, '%G-%V') AS week,
  sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / 1e2 / nullif(count(l_extendedprice), 0) AS l_extendedprice
  FROM lineitem GROUP BY ALL)
SELECT *, CASE WHEN l_extendedprice_change > 0 THEN 'up' WHEN l_extendedprice_change < 0 THEN 'down' END
  AS l_extendedprice_direction FROM (SELECT *, l_extendedprice - lag(l_extendedprice) OVER
  (PARTITION BY l_suppkey ORDER BY week) AS l_extendedprice_change FROM weekly)""")
def weekly_trend_large(t: Tables) -> DataFrame:
    """Weekly means and their change over the largest table."""
    dated = t.lineitem.select("l_suppkey", iso_week("l_shipdate").alias("week"), "l_extendedprice")
    weekly = weekly_values(dated, ["l_suppkey"], "week", ["l_extendedprice"])
    return change_from_previous(weekly, ["l_suppkey"], "week", {"l_extendedprice": True})


@query("""WITH daily AS (SELECT event_type, ts::DATE AS day, sum(round(value * 100)::BIGINT)::DOUBLE / 1e2 AS visibility
  FROM events GROUP BY ALL)
SELECT *, (sum(round(visibility * 100)::BIGINT) OVER w)::DOUBLE / 1e2 / nullif(count(visibility) OVER w, 0)
  AS visibility_ma
FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def moving_avg_7(t: Tables) -> DataFrame:
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        total(F.col("value")).alias("visibility")
    )
    return moving_average(daily, ["event_type"], "day", "visibility", 7)


@query("""SELECT o_orderdate::DATE AS day, o_orderkey, o_totalprice FROM orders
  WHERE o_orderdate::DATE BETWEEN DATE '1996-06-30' - 30 AND DATE '1996-06-30'""")
def rolling_30d(t: Tables) -> DataFrame:
    """The as-of day lies inside the table's years, so days before and after the window are cut off."""
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_totalprice")
    return reports.recent(rows, "day", F.lit("1996-06-30").cast("date"))


# All engines of the bindings: one per leading digit.
ENGINES = [f"engine_{digit}" for digit in range(10)]


HEAT = ", ".join(f"""{b.sql_mean('visibility_score', f"engine = '{engine}'")} AS {engine}""" for engine in ENGINES)


@query(f"WITH {b.SNAP_FACT} SELECT topic_id, {HEAT} FROM fact GROUP BY ALL")
def heatmap_pivot(t: Tables) -> DataFrame:
    return reports.heat_map(_facts(t), ENGINES)


@query(f"""WITH {b.SNAP_FACT} SELECT snapshot_week, topic_id, {b.sql_mean('visibility_score', 'is_own_brand')} AS own,
  {b.sql_mean('visibility_score', 'NOT is_own_brand')} AS competitors FROM fact GROUP BY ALL""")
def own_and_competitors(t: Tables) -> DataFrame:
    return reports.own_and_competitors(_facts(t), ["snapshot_week", "topic_id"])


@query(f"""WITH {b.SNAP_FACT} SELECT brand_name, sum(ai_share_of_voice::VARCHAR::DECIMAL(38, 30))::DOUBLE /
  nullif(count(ai_share_of_voice), 0) AS avg_share_of_voice FROM fact GROUP BY ALL""")
def share_by_brand(t: Tables) -> DataFrame:
    return reports.share_by_brand(_shared_facts(t))


@query("""SELECT o_custkey, sum((o_totalprice / 64)::VARCHAR::DECIMAL(38, 24))::DOUBLE AS total,
  sum((o_totalprice / 64)::VARCHAR::DECIMAL(38, 24))::DOUBLE / count(o_totalprice) AS mean FROM orders GROUP BY ALL""")
def exact_sums(t: Tables) -> DataFrame:
    """Sums of values with eight decimals, none of which is rounded before it is added."""
    value = F.col("o_totalprice") / 64
    return t.orders.groupBy("o_custkey").agg(total(value).alias("total"), mean(value).alias("mean"))


@query("SELECT lang, source, count(*) AS rows, count(DISTINCT n_chars) AS distinct_n_chars FROM documents GROUP BY ALL")
def counts_by_dim(t: Tables) -> DataFrame:
    return reports.counts_by(t.documents, ["lang", "source"], distinct="n_chars")


@query(f"""WITH {b.SNAP} SELECT brand_id, max(last_snapshot_at) AS stored_max FROM snap GROUP BY ALL""")
def stored_marks(t: Tables) -> DataFrame:
    """Newest snapshot per brand."""
    return freshness.stored_marks(b.snapshots(t))


@query("""SELECT event_type AS brand_name, (sum(k)::BIGINT)::DOUBLE / nullif(count(*), 0) AS mean_sentiment FROM
  (SELECT event_type, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events) GROUP BY ALL""")
def mean_sentiment(t: Tables) -> DataFrame:
    """Score sum over score count."""
    scores = t.events.select(
        F.col("event_type").alias("brand_name"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("score_sum"),
        F.lit(1).cast("bigint").alias("score_count"),
    )
    return reports.mean_sentiment(scores, ["brand_name"])


# --- report timelines ---------------------------------------------------------------------


@query(f"""WITH {b.REPORT}, latest AS (SELECT * FROM report WHERE snapshot_date = (SELECT max(snapshot_date) FROM report))
SELECT topic_name, brand_name, is_own_brand, visibility_score,
  rank() OVER (PARTITION BY topic_name ORDER BY visibility_score DESC) AS position FROM latest""")
def rank_in_group_latest(t: Tables) -> DataFrame:
    return reports.topic_ranking(layers.report_table(b.report_rows(t)))


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice, rank() OVER (PARTITION BY o_orderpriority
  ORDER BY o_totalprice DESC) AS position FROM orders""")
def rank_in_large_groups(t: Tables) -> DataFrame:
    """Rank where a few groups hold the whole table: no task holds a group."""
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rank_in_group(rows, ["o_orderpriority"], "o_totalprice", "position")


@query(f"""WITH {b.REPORT} SELECT snapshot_date, topic_name, visibility_score, mentions::DOUBLE AS sentiment,
  mentions::DOUBLE AS detection_rate FROM report WHERE owning_brand_id = 'ws-2' AND is_own_brand""")
def topic_timeline(t: Tables) -> DataFrame:
    rows = b.report_rows(t).withColumns(
        {"sentiment": F.col("mentions").cast("double"), "detection_rate": F.col("mentions").cast("double")}
    )
    return reports.topic_timeline(layers.report_table(rows), "ws-2")


# --- citations ----------------------------------------------------------------------------


@query(f"""WITH {b.CITES} SELECT domain, sum(occurrences)::BIGINT AS total_citations, count(DISTINCT url) AS unique_urls
FROM cites GROUP BY ALL ORDER BY total_citations DESC, domain LIMIT 20""")
def domain_totals(t: Tables) -> DataFrame:
    return reports.domain_totals(b.citations(t))


@query(f"""WITH {b.CITES}, one AS (SELECT min(brand_name) AS brand FROM cites), day AS (SELECT max(snapshot_date) - 200 AS d FROM cites)
SELECT domain, sum(occurrences)::BIGINT AS total_citations, count(DISTINCT url) AS unique_urls
FROM cites WHERE snapshot_date BETWEEN (SELECT d FROM day) - 30 AND (SELECT d FROM day) AND brand_name = (SELECT brand FROM one)
GROUP BY ALL ORDER BY total_citations DESC, domain LIMIT 20""")
def recent_domain_totals(t: Tables) -> DataFrame:
    """The domains of 30 days inside the table's years and of one brand."""
    cited = b.citations(t).withColumn("brand_id", F.col("brand_name"))
    brand, newest = cited.agg(F.min("brand_id"), F.date_sub(F.max("snapshot_date"), 200)).first()
    return reports.domain_totals(cited, as_of=F.lit(newest), brand=brand)


@query("""SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain, count(*) AS total_citations,
  count(DISTINCT url) AS unique_urls FROM pages GROUP BY ALL ORDER BY total_citations DESC, domain LIMIT 20""")
def page_domain_totals(t: Tables) -> DataFrame:
    """The same over page URLs, whose host is the domain."""
    pages = t.pages.select(url_domain(F.col("url")).alias("domain"), "url", F.lit(1).cast("bigint").alias("occurrences"))
    return reports.domain_totals(pages)


@query(f"""WITH {b.CITES} SELECT engine, count(DISTINCT url) AS unique_urls, sum(occurrences)::BIGINT AS total
FROM cites WHERE domain = 'site-7.example' GROUP BY ALL""")
def domain_by_engine(t: Tables) -> DataFrame:
    return reports.domain_by_engine(b.citations(t), "site-7.example")


@query(f"""WITH {b.CITES} SELECT domain, url, occurrences, engine FROM cites JOIN orders
  ON search_term_id = o_orderkey::VARCHAR WHERE o_orderpriority = '1-URGENT'""")
def citations_of_topic(t: Tables) -> DataFrame:
    terms = t.orders.select(
        F.col("o_orderkey").cast("string").alias("search_term_id"), F.col("o_orderpriority").alias("topic_name")
    )
    return reports.citations_of_topic(b.citations(t), terms, "1-URGENT")


@query(f"""WITH {b.CITES}, sums AS (SELECT brand_name, domain, sum(occurrences)::BIGINT AS occurrences FROM cites
  GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand_name ORDER BY occurrences DESC, domain) AS position
  FROM sums) WHERE position <= 10""")
def topn_per_group(t: Tables) -> DataFrame:
    return reports.top_domains(b.citations(t), ["brand_name"], reports.DOMAINS_PER_COMPETITOR)


@query(f"""WITH {b.CITES} SELECT search_term_id, engine, url, min(snapshot_date) AS first_seen,
  max(snapshot_date) AS last_seen, sum(occurrences)::BIGINT AS citation_count FROM cites GROUP BY ALL""")
def citation_log(t: Tables) -> DataFrame:
    return reports.citation_log(b.citations(t))


# --- answers ------------------------------------------------------------------------------


@query(f"""WITH {b.ANSWERS} SELECT execution_id, executed_at, engine, answer_text FROM fact_answers
WHERE search_term_id = 'term-assistant' ORDER BY executed_at DESC, execution_id LIMIT 10""")
def latest_answers(t: Tables) -> DataFrame:
    return reports.latest_answers(layers.fact_answer_texts(b.answers(t)), "term-assistant")


WORDS = r"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}'']+'), lambda w: w <> '')"
MENTIONS = f"""spelled AS (SELECT 'brand-' || (item_id // 10)::VARCHAR AS brand_name, text AS spelling FROM benchmark
  UNION ALL SELECT 'brand-' || (item_id // 10)::VARCHAR, unnest(string_split_regex(text, '[.!?\n]+')) FROM benchmark),
names AS (SELECT DISTINCT brand_name, {WORDS.format(text='spelling')} AS w FROM spelled WHERE len({WORDS.format(text='spelling')}) > 0),
places AS (SELECT doc_id, words, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos
  FROM (SELECT doc_id, {WORDS.format(text='text')} AS words FROM documents)),
found AS (SELECT doc_id, brand_name, count(DISTINCT pos) AS mention_count, min(pos)::BIGINT AS first_position
  FROM places JOIN names ON word = w[1] AND words[pos + 1 : pos + len(w)] = w GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY first_position) AS position_rank FROM found)"""


def _ranked_mentions(t: Tables) -> DataFrame:
    """Brands whose spellings are the benchmark texts and all their sentences, found in all documents."""
    brand = F.concat(F.lit("brand-"), F.floor(F.col("item_id") / 10).cast("string")).alias("brand_name")
    whole = t.benchmark.select(brand, F.col("text").alias("spelling"))
    sentences = t.benchmark.select(brand, F.explode(F.split("text", r"[.!?\n]+")).alias("spelling"))
    return rank_mentions(mentions(t.documents, whole.unionByName(sentences), "text", "doc_id"), "doc_id")


@query(f"WITH {MENTIONS} SELECT * FROM ranked")
def mention_rank(t: Tables) -> DataFrame:
    return _ranked_mentions(t)


@query(f"""WITH {MENTIONS} SELECT brand_name, count(*) AS appearances,
  count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents) AS detection_rate,
  count(*) FILTER (position_rank <= 3) * 100.0::DOUBLE / count(*) AS top3_rate,
  sum(position_rank)::DOUBLE / count(*) AS avg_rank FROM ranked GROUP BY ALL""")
def mention_detection(t: Tables) -> DataFrame:
    return detection_metrics(_ranked_mentions(t), t.documents.count())


# --- metric star --------------------------------------------------------------------------


@query(f"""WITH {b.STAR} SELECT engine_id, is_own_brand,
  {b.sql_mean('metric_value', "metric_type = 'VISIBILITY'", 3)} AS avg_visibility,
  {b.sql_mean('metric_value', "metric_type = 'POSITION_RANK'", 1)} AS avg_rank,
  {b.sql_mean('metric_value', "metric_type = 'DETECTION_RATE'", 3)} AS avg_detection
FROM star GROUP BY ALL""")
def eav_scorecard(t: Tables) -> DataFrame:
    return reports.engine_scorecard(reports.metric_star(b.metrics(t), b.runs(t), b.prompts(t)))


@query(f"""WITH {b.STAR} SELECT topic_name, prompt_text, engine_id, count(DISTINCT run_id) AS weeks_tracked,
  {b.sql_mean('metric_value', "metric_type = 'VISIBILITY' AND is_own_brand", 2)} AS avg_visibility,
  {b.sql_mean('metric_value', "metric_type = 'POSITION_RANK' AND is_own_brand", 1)} AS avg_rank
FROM star GROUP BY ALL""")
def prompt_list(t: Tables) -> DataFrame:
    return reports.prompt_list(_star(t))


@query(f"""WITH {b.STAR} SELECT topic_name, brand_name, is_own_brand,
  {b.sql_mean('metric_value', "metric_type = 'VISIBILITY'", 3)} AS avg_visibility,
  {b.sql_mean('metric_value', "metric_type = 'SENTIMENT'", 3)} AS avg_sentiment,
  {b.sql_mean('metric_value', "metric_type = 'POSITION_RANK'", 1)} AS avg_rank,
  {b.sql_mean('metric_value', "metric_type = 'DETECTION_RATE'", 3)} AS avg_detection,
  sum(CASE WHEN metric_type = 'CITATION_COUNT' THEN round(metric_value * 100)::BIGINT END)::DOUBLE / 1e2
    AS total_citations
FROM star GROUP BY ALL""")
def own_vs_competition(t: Tables) -> DataFrame:
    return reports.own_vs_competitors(_star(t))


@query(f"""WITH {b.STAR} SELECT (executed_at::DATE - dayofweek(executed_at)::INTEGER)::DATE AS week, topic_name,
  brand_name, is_own_brand, {b.sql_mean('metric_value', "metric_type = 'VISIBILITY'", 3)} AS avg_visibility,
  {b.sql_mean('metric_value', "metric_type = 'SENTIMENT'", 3)} AS avg_sentiment,
  {b.sql_mean('metric_value', "metric_type = 'POSITION_RANK'", 1)} AS avg_rank
FROM star WHERE is_own_brand OR brand_name IN ('brand_A') GROUP BY ALL""")
def sunday_week_timeline(t: Tables) -> DataFrame:
    return reports.competition_timeline(_star(t), ["brand_A"], "executed_at")


@query(f"""WITH {b.STAR} SELECT (executed_at::DATE - dayofweek(executed_at)::INTEGER)::DATE AS week, monitor_name, entity_type,
  {b.sql_mean('metric_value', None, 3)} AS avg_visibility FROM star WHERE metric_type = 'VISIBILITY' GROUP BY ALL""")
def monitored_timeline(t: Tables) -> DataFrame:
    return reports.monitored_timeline(_star(t), "executed_at")


@query(f"""WITH {b.STAR}, means AS (SELECT prompt_id, prompt_text, topic_name, engine_id,
    {b.sql_mean('metric_value', "metric_type = 'VISIBILITY' AND is_own_brand")} AS own,
    {b.sql_mean('metric_value', "metric_type = 'VISIBILITY' AND NOT is_own_brand")} AS others
  FROM star GROUP BY ALL)
SELECT topic_name, prompt_text, engine_id, {b.sql_round('own', 3)} AS own_visibility,
  {b.sql_round('others', 3)} AS competitors_avg, {b.sql_round('(others - own)', 3)} AS gap
FROM means WHERE own IS NOT NULL
ORDER BY gap DESC NULLS LAST, prompt_text, topic_name, engine_id LIMIT 20""")
def gap_top20(t: Tables) -> DataFrame:
    return reports.lagging_prompts(_star(t))


@query(f"""WITH {b.STAR} SELECT monitor_name, entity_type, {b.sql_mean('metric_value', None, 3)} AS avg_visibility,
  count(*) AS run_count FROM star WHERE metric_type = 'VISIBILITY' GROUP BY ALL""")
def avg_by_attribute(t: Tables) -> DataFrame:
    return reports.average_metric(
        _star(t), "VISIBILITY", ["monitor_name", "entity_type"], "avg_visibility"
    )


@query(f"""WITH {b.STAR} SELECT product, funnel,
  {b.sql_mean('metric_value', "metric_type = 'VISIBILITY'", 3)} AS avg_visibility,
  {b.sql_mean('metric_value', "metric_type = 'SENTIMENT'", 3)} AS avg_sentiment,
  count(DISTINCT run_id) AS run_count FROM star WHERE entity_type = 'OWN_BRAND' GROUP BY ALL""")
def product_breakdown(t: Tables) -> DataFrame:
    return reports.product_breakdown(_star(t))


@query(f"""WITH {b.STAR} SELECT ai_provider, ai_model, {b.sql_mean('metric_value', None, 3)} AS avg_sentiment,
  count(*) AS run_count FROM star WHERE metric_type = 'SENTIMENT' AND entity_type = 'OWN_BRAND' GROUP BY ALL""")
def sentiment_by_model(t: Tables) -> DataFrame:
    own = _star(t).where(F.col("entity_type") == "OWN_BRAND")
    return reports.average_metric(own, "SENTIMENT", ["ai_provider", "ai_model"], "avg_sentiment")


@query(f"""WITH {b.STAR} SELECT source, entity_type, {b.sql_mean('metric_value', None, 3)} AS recommendation_rate,
  count(*) AS run_count FROM star WHERE metric_type = 'RECOMMENDATION' GROUP BY ALL""")
def recommendation_by_source(t: Tables) -> DataFrame:
    return reports.average_metric(
        _star(t), "RECOMMENDATION", ["source", "entity_type"], "recommendation_rate", first=["source"]
    )


# --- metrics as rows ----------------------------------------------------------------------


def _runs(t: Tables) -> DataFrame:
    return eav.prompt_runs(b.snapshots(t))


UNPIVOTED = f"""runs AS (SELECT *, search_term_id || '_' || strftime(last_snapshot_at, '%G-%V') AS run_id FROM snap),
long AS (
  SELECT run_id, brand_name, is_own_brand, 'VISIBILITY' AS metric_type, visibility_score / 100 AS metric_value FROM runs
  UNION ALL SELECT run_id, brand_name, is_own_brand, 'SENTIMENT', (avg_sentiment - 50) / 50 FROM runs
  UNION ALL SELECT run_id, brand_name, is_own_brand, 'POSITION_RANK', avg_rank FROM runs
  UNION ALL SELECT run_id, brand_name, is_own_brand, 'DETECTION_RATE', detection_rate / 100 FROM runs
  UNION ALL SELECT run_id, brand_name, is_own_brand, 'TOP3_RATE', top3_rate / 100 FROM runs
  UNION ALL SELECT run_id, brand_name, is_own_brand, 'CITATION_COUNT', citation_count::DOUBLE FROM runs),
kept AS (SELECT *, concat_ws('_', run_id, brand_name, metric_type) AS metric_id FROM long
  WHERE metric_value IS NOT NULL)"""


@query(f"WITH {b.SNAP}, {UNPIVOTED} SELECT * FROM kept")
def eav_unpivot(t: Tables) -> DataFrame:
    return eav.unpivot_metrics(_runs(t))


@query(f"""WITH {b.SNAP}, {UNPIVOTED} SELECT *, CASE WHEN metric_type = 'SENTIMENT' THEN
  CASE WHEN metric_value > 0 THEN 'POSITIVE' WHEN metric_value < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END END
  AS metric_label FROM kept""")
def sentiment_labels(t: Tables) -> DataFrame:
    return eav.label_metrics(eav.unpivot_metrics(_runs(t)))


@query(f"""WITH {b.SNAP}, {UNPIVOTED} SELECT run_id, brand_name, is_own_brand, 'RECOMMENDATION' AS metric_type,
  (metric_value >= 0.8)::INTEGER::DOUBLE AS metric_value FROM kept WHERE metric_type = 'DETECTION_RATE'""")
def recommendations(t: Tables) -> DataFrame:
    return eav.recommendations(eav.unpivot_metrics(_runs(t)))


@query("""SELECT c_custkey AS prompt_id, CASE WHEN source IS NULL THEN CASE c_nationkey WHEN 1 THEN 'brand' WHEN 2
    THEN 'loan' WHEN 3 THEN 'invest' END ELSE 'kept' END AS product,
  coalesce(source, 'Custom') AS source, CASE WHEN source IS NULL THEN 'Think' ELSE 'Do' END AS funnel,
  CASE WHEN source IS NULL THEN 'inform' ELSE 'transaction' END AS type
FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS source FROM customer)""")
def enriched_prompts(t: Tables) -> DataFrame:
    """Default dimensions for prompts nobody has classified; the others stay."""
    raw = t.customer.select(
        F.col("c_custkey").alias("prompt_id"), F.col("c_nationkey").cast("string").alias("topic_id"),
        F.lit("kept").alias("product"), F.lit("Do").alias("funnel"), F.lit("transaction").alias("type"),
        F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).alias("source"),
    )
    return eav.fill_defaults(raw, {"1": "brand", "2": "loan", "3": "invest"}).drop("topic_id")


@query(f"""SELECT o_orderkey, CASE prefix WHEN 'bing' THEN 'microsoft' ELSE prefix END AS provider FROM
  (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'bing' WHEN 'F' THEN 'google' ELSE 'openai' END AS prefix
   FROM orders)""")
def engine_providers(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    engine = (
        F.when(status == "O", F.lit("bing_copilot_gui")).when(status == "F", F.lit("google_ai_overview"))
        .otherwise(F.lit("openai_chat"))
    )
    return t.orders.select("o_orderkey", engine_provider(engine).alias("provider"))


@query(f"""SELECT l_orderkey, l_linenumber, {b.sql_round('l_extendedprice / nullif(l_discount * 100, 0)', 1)} AS ratio
FROM lineitem""")
def safe_ratios(t: Tables) -> DataFrame:
    """Safe division and rounding on every row."""
    ratio = safe_divide(F.col("l_extendedprice"), F.col("l_discount") * 100)
    return t.lineitem.select("l_orderkey", "l_linenumber", round_to(ratio, 1).alias("ratio"))


@query(f"""SELECT l_returnflag, {b.sql_mean('l_extendedprice')} AS exact_mean FROM lineitem GROUP BY ALL""")
def exact_means(t: Tables) -> DataFrame:
    """Means that do not depend on the order of partial sums."""
    return t.lineitem.groupBy("l_returnflag").agg(mean(F.col("l_extendedprice"), 2).alias("exact_mean"))
