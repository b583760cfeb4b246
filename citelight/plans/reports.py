"""Report queries over the denormalised tables and the metric star.

Averages and totals are exact sums (:mod:`citelight.functions.arithmetic`).
``as_of`` is the report's day, as a Column. Facts are stored by ``snapshot_week``, so every filter on a day also names the
weeks that its days lie in, which prunes folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import iso_week, mean, round_to, safe_divide, sunday_week, total
from ..operators.latest import top_per_group
from ..operators.rank import rank_in_group
from ..operators.tags import own_or_listed
from ..operators.trend import change_from_previous, weekly_values

# List lengths of the reports.
TOP_COMPETITORS = 10
TOP_TERMS = 10
TOP_DOMAINS = 20
TOP_GAPS = 20
LATEST_ANSWERS = 10
RECENT_DAYS = 30
# Lengths of the per-group domain lists.
DOMAINS_PER_COMPETITOR = 10
#: Decimals that sums of shares carry: shares may be small, and their sums stay far below 10**8.
SHARE_SCALE = 30


def between_days(df: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Rows from ``first`` to ``last``, both days included.

    A table with ``snapshot_week``, the ISO week of ``day`` in all tables of this library, is read in these weeks only.
    """
    inside = F.col(day).between(first, last)
    if "snapshot_week" in df.columns:
        inside = F.col("snapshot_week").between(iso_week(first), iso_week(last)) & inside
    return df.where(inside)


def on_day(df: DataFrame, day: Column) -> DataFrame:
    """Rows of one ``snapshot_date``."""
    return between_days(df, "snapshot_date", day, day)


def recent(df: DataFrame, day: str, as_of: Column, days: int = RECENT_DAYS) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``, that day included."""
    return between_days(df, day, F.date_sub(as_of, days), as_of)


def in_week(df: DataFrame, as_of: Column, week: str = "snapshot_week") -> DataFrame:
    """Rows of the ISO week of ``as_of``."""
    return df.where(F.col(week) == iso_week(as_of))


# --- over L2_snapshots --------------------------------------------------------------------


def weekly_averages(
    snapshots: DataFrame, by: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Own brand: mean of each measure per week and dimension."""
    return (
        snapshots.where("is_own_brand").groupBy("snapshot_week", *by)
        .agg(*[mean(F.col(m)).alias(f"mean_{m}") for m in measures])
        .orderBy("snapshot_week", *by)
    )


def current_week_by(
    snapshots: DataFrame, by: str, as_of: Column, measures: Sequence[str]
) -> DataFrame:
    """Own brand: mean of each measure per dimension in the week of ``as_of``."""
    return in_week(snapshots.where("is_own_brand"), as_of).groupBy(by).agg(
        *[mean(F.col(m)).alias(f"mean_{m}") for m in measures]
    )


def top_competitors(
    snapshots: DataFrame, as_of: Column, n: int = TOP_COMPETITORS
) -> DataFrame:
    """Competitors with the highest mean visibility in the week of ``as_of``."""
    return (
        in_week(snapshots.where(~F.col("is_own_brand")), as_of).groupBy("brand_name")
        .agg(
            mean(F.col("visibility_score")).alias("avg_visibility"),
            mean(F.col("detection_rate")).alias("avg_detection"),
        )
        .orderBy(F.desc("avg_visibility"), "brand_name").limit(n)
    )


def prompt_comparison(snapshots: DataFrame, term: str) -> DataFrame:
    """All brands of one search term, week by week."""
    return (
        snapshots.where(F.col("search_term_id") == term)
        .select("snapshot_week", "brand_name", "is_own_brand", "visibility_score", "ai_share_of_voice")
        .orderBy("snapshot_week", F.desc("is_own_brand"), "brand_name")
    )


def top_terms(snapshots: DataFrame, day: Column, n: int = TOP_TERMS) -> DataFrame:
    """Search terms on which the own brand is most visible on one day."""
    return (
        on_day(snapshots, day).where("is_own_brand")
        .select("search_term_id", "query", "topic_id", "visibility_score", "avg_rank", "appearances")
        .orderBy(F.desc("visibility_score"), "search_term_id").limit(n)
    )


def term_trends(snapshots: DataFrame) -> DataFrame:
    """Own brand: weekly visibility and position per term, with the change to the week before."""
    weekly = weekly_values(
        snapshots.where("is_own_brand"), ["search_term_id"], "snapshot_week",
        ["visibility_score", "avg_rank"],
    )
    return change_from_previous(
        weekly, ["search_term_id"], "snapshot_week", {"visibility_score": True, "avg_rank": False}
    )


def rising_terms(trends: DataFrame, week: Column) -> DataFrame:
    """Terms whose visibility rose in one week, largest rise first."""
    return (
        trends.where((F.col("snapshot_week") == week) & (F.col("visibility_score_direction") == "up"))
        .select("search_term_id", "visibility_score", "visibility_score_change", "visibility_score_direction")
        .orderBy(F.desc("visibility_score_change"), "search_term_id")
    )


def topic_breakdown(snapshots: DataFrame, day: Column) -> DataFrame:
    """Mean visibility and number of terms per topic on one day."""
    return (
        on_day(snapshots, day).groupBy("topic_id")
        .agg(
            mean(F.col("visibility_score")).alias("avg_visibility"),
            F.count(F.lit(1)).alias("term_count"),
        )
        .orderBy(F.desc("avg_visibility"), "topic_id")
    )


def heat_map(
    snapshots: DataFrame, engines: Sequence[str], measure: str = "visibility_score"
) -> DataFrame:
    """Topic by engine: mean of a measure, one column per engine."""
    return snapshots.groupBy("topic_id").pivot("engine", list(engines)).agg(mean(F.col(measure)))


def own_and_competitors(
    snapshots: DataFrame, by: Sequence[str], measure: str = "visibility_score"
) -> DataFrame:
    """Own mean and competitors' mean of a measure side by side."""
    own = F.col("is_own_brand")
    return snapshots.groupBy(*by).agg(
        mean(F.when(own, F.col(measure))).alias("own"),
        mean(F.when(~own, F.col(measure))).alias("competitors"),
    )


def share_by_brand(snapshots: DataFrame) -> DataFrame:
    """Mean share of voice per brand."""
    share = F.col("ai_share_of_voice")
    return snapshots.groupBy("brand_name").agg(mean(share, SHARE_SCALE).alias("avg_share_of_voice"))


def counts_by(df: DataFrame, by: Sequence[str], distinct: str | None = None) -> DataFrame:
    """Rows, and distinct values of a column, per dimension."""
    measures = [F.count(F.lit(1)).alias("rows")]
    if distinct is not None:
        measures.append(F.count_distinct(distinct).alias(f"distinct_{distinct}"))
    return df.groupBy(*by).agg(*measures)


def topic_tags(terms_tags: DataFrame) -> DataFrame:
    """Distinct tags per topic, one row each, from the tag bridge."""
    return terms_tags.select("topic_id", "tag").distinct()


def mean_sentiment(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Score sum over score count per brand, or per brand and engine."""
    return scores.groupBy(*by).agg(
        safe_divide(F.sum("score_sum").cast("double"), F.sum("score_count")).alias("mean_sentiment")
    )


# --- over the report timelines ------------------------------------------------------------


def topic_ranking(report: DataFrame, owner: str | None = None) -> DataFrame:
    """Brands of each topic ranked by visibility on the newest day, by topic and position."""
    newest = report.agg(F.max("snapshot_date")).scalar()
    latest = report.where(F.col("snapshot_date") == newest)
    if owner is not None:
        latest = latest.where(F.col("owning_brand_id") == owner)
    return rank_in_group(latest, ["topic_name"], "visibility_score", "position").select(
        "topic_name", "brand_name", "is_own_brand", "visibility_score", "position"
    ).orderBy("topic_name", "position", "brand_name")


def topic_timeline(report: DataFrame, owner: str) -> DataFrame:
    """Own brand's timeline per topic."""
    return (
        report.where((F.col("owning_brand_id") == owner) & F.col("is_own_brand"))
        .select("snapshot_date", "topic_name", "visibility_score", "sentiment", "detection_rate")
        .orderBy("topic_name", "snapshot_date")
    )


# --- over L2_citations --------------------------------------------------------------------


def domain_totals(
    citations: DataFrame, n: int = TOP_DOMAINS, as_of: Column | None = None, days: int = RECENT_DAYS,
    brand: str | None = None,
) -> DataFrame:
    """Most cited domains: citations and distinct URLs; of the last ``days`` days up to ``as_of`` and of one brand, if given."""
    if as_of is not None:
        citations = recent(citations, "snapshot_date", as_of, days)
    if brand is not None:
        citations = citations.where(F.col("brand_id") == brand)
    return (
        citations.groupBy("domain")
        .agg(F.sum("occurrences").alias("total_citations"), F.count_distinct("url").alias("unique_urls"))
        .orderBy(F.desc("total_citations"), "domain").limit(n)
    )


def domain_by_engine(citations: DataFrame, domain: str) -> DataFrame:
    """Citations of one domain per engine."""
    return (
        citations.where(F.col("domain") == domain).groupBy("engine")
        .agg(F.count_distinct("url").alias("unique_urls"), F.sum("occurrences").alias("total"))
        .orderBy(F.desc("total"), "engine")
    )


def citations_of_topic(citations: DataFrame, terms: DataFrame, topic: str) -> DataFrame:
    """Citations of the search terms now assigned to a topic."""
    chosen = terms.where(F.col("topic_name") == topic).select("search_term_id")
    return (
        citations.join(chosen, "search_term_id")
        .select("domain", "url", "occurrences", "engine")
        .orderBy(F.desc("occurrences"), "domain", "url", "engine")
    )


def top_domains(citations: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The ``n`` most cited domains of each engine, query, brand, ..."""
    sums = citations.groupBy(*by, "domain").agg(F.sum("occurrences").alias("occurrences"))
    return top_per_group(sums, by, [F.desc("occurrences"), F.asc("domain")], n)


def citation_log(citations: DataFrame, seen: str = "snapshot_date") -> DataFrame:
    """Per term, engine and URL: first and last day seen and total count."""
    return citations.groupBy("search_term_id", "engine", "url").agg(
        F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"),
        F.sum("occurrences").alias("citation_count"),
    )


# --- over answer texts --------------------------------------------------------------------


def latest_answers(answers: DataFrame, term: str, n: int = LATEST_ANSWERS) -> DataFrame:
    """Newest answers to one search term."""
    return (
        answers.where(F.col("search_term_id") == term)
        .orderBy(F.desc("executed_at"), "execution_id").limit(n)
        .select("execution_id", "executed_at", "engine", "answer_text")
    )


# --- over the metric star -----------------------------------------------------------------


def metric_star(
    metrics: DataFrame, runs: DataFrame, prompts: DataFrame,
    topics: DataFrame | None = None, brands: DataFrame | None = None,
) -> DataFrame:
    """Metrics joined with their run, prompt and, where given, topic and monitoring brand.

    The tables are joined from the smallest up, so metrics, by far the largest, move
    once (by run) and filters on prompts or brands shrink the runs before that.
    """
    context = prompts
    if topics is not None:
        context = context.join(topics, "topic_id")
    if brands is not None:
        context = context.join(brands, "brand_id")
    return metrics.join(runs.join(context, "prompt_id"), "run_id")


def _metric(kind: str, extra: Column | None = None) -> Column:
    wanted = F.col("metric_type") == kind
    return F.when(wanted if extra is None else wanted & extra, F.col("metric_value"))


def _average(kind: str, places: int, extra: Column | None = None) -> Column:
    return round_to(mean(_metric(kind, extra)), places)


def prompt_list(star: DataFrame) -> DataFrame:
    """Prompts per topic with weeks tracked and the own brand's visibility and rank."""
    own = F.col("is_own_brand")
    return (
        star.groupBy("topic_name", "prompt_text", "engine_id")
        .agg(
            F.count_distinct("run_id").alias("weeks_tracked"),
            _average("VISIBILITY", 2, own).alias("avg_visibility"),
            _average("POSITION_RANK", 1, own).alias("avg_rank"),
        )
        .orderBy("topic_name", F.desc("avg_visibility"), "prompt_text", "engine_id")
    )


def own_vs_competitors(star: DataFrame) -> DataFrame:
    """Brands per topic: mean visibility, sentiment, rank, detection, and citations."""
    return (
        star.groupBy("topic_name", "brand_name", "is_own_brand")
        .agg(
            _average("VISIBILITY", 3).alias("avg_visibility"),
            _average("SENTIMENT", 3).alias("avg_sentiment"),
            _average("POSITION_RANK", 1).alias("avg_rank"),
            _average("DETECTION_RATE", 3).alias("avg_detection"),
            total(_metric("CITATION_COUNT")).alias("total_citations"),
        )
        .orderBy("topic_name", F.desc("avg_visibility"), "brand_name")
    )


def competition_timeline(star: DataFrame, listed: Sequence[str], day: str) -> DataFrame:
    """Own brand and listed competitors per Sunday-based week and topic."""
    return (
        star.where(own_or_listed(listed))
        .groupBy(sunday_week(day).alias("week"), "topic_name", "brand_name", "is_own_brand")
        .agg(
            _average("VISIBILITY", 3).alias("avg_visibility"),
            _average("SENTIMENT", 3).alias("avg_sentiment"),
            _average("POSITION_RANK", 1).alias("avg_rank"),
        )
        .orderBy("week", "topic_name", F.desc("avg_visibility"), "brand_name")
    )


def engine_scorecard(star: DataFrame) -> DataFrame:
    """Engines: own brand against competitors."""
    return (
        star.groupBy("engine_id", "is_own_brand")
        .agg(
            _average("VISIBILITY", 3).alias("avg_visibility"),
            _average("POSITION_RANK", 1).alias("avg_rank"),
            _average("DETECTION_RATE", 3).alias("avg_detection"),
        )
        .orderBy("engine_id", F.desc("is_own_brand"))
    )


def lagging_prompts(star: DataFrame, n: int = TOP_GAPS) -> DataFrame:
    """Prompts on which the competitors' mean visibility exceeds the own brand's most."""
    own = F.col("is_own_brand")
    means = star.groupBy("prompt_id", "prompt_text", "topic_name", "engine_id").agg(
        mean(_metric("VISIBILITY", own)).alias("_own"),
        mean(_metric("VISIBILITY", ~own)).alias("_others"),
    )
    return (
        means.where(F.col("_own").isNotNull())
        .select(
            "topic_name", "prompt_text", "engine_id",
            round_to(F.col("_own"), 3).alias("own_visibility"),
            round_to(F.col("_others"), 3).alias("competitors_avg"),
            round_to(F.col("_others") - F.col("_own"), 3).alias("gap"),
        )
        .orderBy(F.desc("gap"), "prompt_text", "topic_name", "engine_id").limit(n)
    )


def average_metric(
    star: DataFrame, kind: str, by: Sequence[str], out: str, places: int = 3, first: Sequence[str] = ()
) -> DataFrame:
    """Mean of one metric and number of its rows per dimension, sorted by ``first`` and then the largest mean."""
    means = star.where(F.col("metric_type") == kind).groupBy(*by).agg(
        round_to(mean(F.col("metric_value")), places).alias(out), F.count(F.lit(1)).alias("run_count")
    )
    return means.orderBy(*first, F.desc(out), *[c for c in by if c not in first])


def monitored_timeline(star: DataFrame, day: str) -> DataFrame:
    """Visibility per Sunday-based week, monitored brand and its entity type; own brands first."""
    return (
        star.where(F.col("metric_type") == "VISIBILITY")
        .groupBy(sunday_week(day).alias("week"), "monitor_name", "entity_type")
        .agg(round_to(mean(F.col("metric_value")), 3).alias("avg_visibility"))
        .orderBy("week", F.desc("entity_type"), "monitor_name")
    )


def product_breakdown(star: DataFrame) -> DataFrame:
    """Own brand by product and funnel stage."""
    return (
        star.where(F.col("entity_type") == "OWN_BRAND").groupBy("product", "funnel")
        .agg(
            _average("VISIBILITY", 3).alias("avg_visibility"),
            _average("SENTIMENT", 3).alias("avg_sentiment"),
            F.count_distinct("run_id").alias("run_count"),
        )
        .orderBy("product", "funnel")
    )
