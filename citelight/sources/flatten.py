"""Payloads to rows.

Each function takes payloads (columns ``brand_id`` and, for reports, ``topic_id``,
``topic_name``, ``brand_name``; column ``data`` with the document) and returns the
rows of a landing table without the load stamp. All of them are projections and
generators: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    business_key,
    first_or_blank,
    firestore_timestamp,
    iso_week,
    json_text_array,
    parse_timestamp,
    row_uuid,
    snapshot_day,
    text_day,
)

# Order in which a report's periods are tried.
PERIODS = ("weekly", "daily", "monthly", "hourly")

# Measure in a snapshot payload -> column.
SNAPSHOT_MEASURES = {
    "visibilityScore": "visibility_score",
    "avgSentiment": "avg_sentiment",
    "avgRank": "avg_rank",
    "latestRank": "latest_rank",
    "detectionRate": "detection_rate",
    "top3": "top3_rate",
    "citationCount": "citation_count",
    "appearances": "appearances",
}

# Series in a report payload -> column.
SERIES_MEASURES = {
    "visibilityScore": "visibility_score",
    "sentiment": "sentiment",
    "avgPosition": "avg_position",
    "detectionRate": "detection_rate",
    "top3": "top3",
    "mentions": "mentions",
    "citations": "citations",
}


# --- dimensions ---------------------------------------------------------------------------


def brands(payloads: DataFrame) -> DataFrame:
    """Monitored brands; every brand of this payload is an own brand."""
    return payloads.select(F.inline("data.brands")).select(
        F.col("id").alias("brand_id"), "name", F.col("url").alias("domain"),
        F.lit(True).alias("is_own_brand"),
    )


def search_terms(payloads: DataFrame) -> DataFrame:
    """One row per prompt and engine; tags as JSON text."""
    terms = payloads.select("brand_id", F.inline("data.searchTerms"))
    return terms.select(
        "brand_id",
        F.col("id").alias("search_term_id"),
        F.col("term").alias("query"),
        first_or_blank(F.col("aiSearchEngines")).alias("engine"),
        F.col("searchTermTopicRef.id").alias("topic_id"),
        F.col("searchTermTopicRef.name").alias("topic_name"),
        "region",
        "interval",
        json_text_array(F.col("tags")).alias("tags"),
        "status",
        parse_timestamp("createdAt").alias("created_at"),
        parse_timestamp("lastExecutionTime").alias("last_execution_time"),
        parse_timestamp("nextScheduledExecutionTime").alias("next_execution_time"),
        F.col("executionsAmount").alias("executions_amount"),
    )


def active_topics(payloads: DataFrame) -> DataFrame:
    """Topics that have search terms; a missing list counts as empty."""
    topics = payloads.select("brand_id", F.inline("data.topics"))
    return topics.where(F.coalesce(F.size("searchTermIds"), F.lit(0)) > 0).select(
        "brand_id", F.col("id").alias("topic_id"), F.col("name").alias("topic_name"),
        F.col("searchTermIds").alias("search_term_ids"),
        firestore_timestamp("createdAt").alias("created_at"),
        firestore_timestamp("updatedAt").alias("updated_at"),
    )


def embedded_terms(payloads: DataFrame) -> DataFrame:
    """Search terms embedded in the brands payload; ids repeat with different ``added_at``."""
    return payloads.select(F.inline("data.brands")).select(
        F.col("id").alias("brand_id"), F.inline("operationalSearchTerms")
    ).select(
        "brand_id", F.col("searchTermId").alias("search_term_id"), "query",
        parse_timestamp("addedAt").alias("added_at"),
    )


# --- search-term report -------------------------------------------------------------------


def _brand_rows(own: Column, competitors: Column) -> Column:
    """Own brand (when present) and competitors as one array, told apart by position."""

    def entry(brand: Column, is_own: bool) -> Column:
        return F.struct(
            brand["name"].alias("brand_name"), F.lit(is_own).alias("is_own_brand"),
            *[brand[field].alias(name) for field, name in SNAPSHOT_MEASURES.items()],
        )

    others = F.transform(competitors, lambda c: entry(c, False))
    mine = F.array(entry(own, True))
    return (
        F.when(own.isNull(), others)
        .when(competitors.isNull(), mine)
        .otherwise(F.concat(mine, others))
    )


def brand_snapshots(payloads: DataFrame) -> DataFrame:
    """One row per search term and brand seen in its answers; no row for an absent own brand."""
    terms = payloads.select("brand_id", F.inline("data.searchTerms"))
    return terms.select(
        "brand_id",
        F.col("searchTermId").alias("search_term_id"),
        first_or_blank(F.col("aiSearchEngines")).alias("engine"),
        F.col("topic.id").alias("topic_id"),
        F.col("topic.name").alias("topic_name"),
        parse_timestamp("lastSnapshotAt").alias("last_snapshot_at"),
        F.inline(_brand_rows(F.col("ownBrand"), F.col("competitors"))),
    )


def latest_payload_snapshot(payloads: DataFrame) -> DataFrame:
    """Newest snapshot time each brand's payloads report (``payload_max``)."""
    terms = payloads.select("brand_id", F.inline("data.searchTerms"))
    return terms.groupBy("brand_id").agg(F.max(parse_timestamp("lastSnapshotAt")).alias("payload_max"))


def dated_brand_snapshots(payloads: DataFrame, run_day: Column) -> DataFrame:
    """Snapshots for the load-by-date tables.

    Adds the snapshot's day (the run's day when unknown) and ISO week, names an
    unnamed brand ``unknown`` and keeps the owner as ``owning_brand_id``, with
    ``brand_id`` only on own-brand rows.
    """
    rows = payloads.select("brand_id", F.inline("data.searchTerms")).select(
        snapshot_day("lastSnapshotAt", run_day).alias("snapshot_date"),
        F.col("searchTermId").alias("search_term_id"),
        F.col("brand_id").alias("owning_brand_id"),
        first_or_blank(F.col("aiSearchEngines")).alias("engine"),
        F.col("topic.id").alias("topic_id"),
        parse_timestamp("lastSnapshotAt").alias("last_snapshot_at"),
        F.inline(_brand_rows(F.col("ownBrand"), F.col("competitors"))),
    )
    name = F.col("brand_name")
    return rows.withColumns({
        "snapshot_week": iso_week("snapshot_date"),
        "brand_name": F.when(name.isNull() | (name == ""), F.lit("unknown")).otherwise(name),
        "brand_id": F.when(F.col("is_own_brand"), F.col("owning_brand_id")),
    })


def answer_texts(payloads: DataFrame) -> DataFrame:
    """One row per execution; a missing or NULL list gives no rows."""
    terms = payloads.select("brand_id", F.inline("data.searchTerms"))
    return terms.select(
        "brand_id", F.col("searchTermId").alias("search_term_id"), F.inline("answerTexts")
    ).select(
        "brand_id", "search_term_id", F.col("executionId").alias("execution_id"),
        parse_timestamp("executedAt").alias("executed_at"), "engine",
        F.col("answerText").alias("answer_text"),
    )


def name_variations(payloads: DataFrame) -> DataFrame:
    """Spellings found for each competitor with their own measures (one level deep)."""
    terms = payloads.select("brand_id", F.inline("data.searchTerms"))
    found = terms.select(
        "brand_id", F.col("searchTermId").alias("search_term_id"), F.inline("competitors")
    ).select("brand_id", "search_term_id", F.col("name").alias("brand_name"), F.inline("variations"))
    return found.select(
        "brand_id", "search_term_id", "brand_name", F.col("name").alias("variant"),
        *[F.col(field).alias(name) for field, name in SNAPSHOT_MEASURES.items()],
    )


def spelling_map(variations: DataFrame) -> DataFrame:
    """Variant to canonical name, one row per variant: the brand seen most often with it."""
    seen = variations.groupBy("variant", "brand_name").agg(F.sum("appearances").alias("appearances"))
    best = seen.groupBy("variant").agg(
        F.max(F.struct(F.coalesce("appearances", F.lit(0)), "brand_name")).alias("_best")
    )
    return best.select("variant", F.col("_best.brand_name").alias("brand_name"))


# --- citations ----------------------------------------------------------------------------


def _urls_or_domain(domain: Column) -> Column:
    """The URLs of a domain; a domain without URLs stands for itself with its own count."""
    none = F.lit(None).cast("string")
    listed = F.transform(
        domain["urls"],
        lambda u: F.struct(u["url"].alias("url"), F.coalesce(u["occurrences"], F.lit(0)).alias("occurrences")),
    )
    alone = F.array(
        F.struct(none.alias("url"), F.coalesce(domain["occurrences"], F.lit(0)).alias("occurrences"))
    )
    return F.when(F.size(domain["urls"]) > 0, listed).otherwise(alone)


def _cited_urls(domains: DataFrame, *carry: Column | str) -> DataFrame:
    """Rows with a ``_domain`` struct to one row per cited URL."""
    return domains.select(
        *carry, F.coalesce("_domain.domain", F.lit("")).alias("domain"),
        F.inline(_urls_or_domain(F.col("_domain"))),
    )


def citations(payloads: DataFrame) -> DataFrame:
    """One row per query, engine, domain and URL."""
    per_query = payloads.select("brand_id", F.inline("data.domainSummary.topDomainsByQuery"))
    per_engine = per_query.select(
        "brand_id", F.get("searchTermIds", F.lit(0)).alias("search_term_id"),
        F.coalesce("query", F.lit("")).alias("query"), F.inline("engines"),
    )
    per_domain = per_engine.select(
        "brand_id", "search_term_id", "query", F.coalesce("engineId", F.lit("")).alias("engine"),
        F.explode("domains").alias("_domain"),
    )
    return _cited_urls(per_domain, "brand_id", "search_term_id", "query", "engine")


def dated_citations(payloads: DataFrame, run_day: Column) -> DataFrame:
    """Citations for the load-by-date tables: day and ISO week of the run."""
    return citations(payloads).drop("query").withColumns(
        {"snapshot_date": run_day, "snapshot_week": iso_week(run_day)}
    )


def domain_rollups(payloads: DataFrame) -> DataFrame:
    """The payload's own top-domain lists: ``scope`` is overall, own, engine or competitor.

    ``member`` names the engine or competitor.
    """
    summary = F.col("data.domainSummary")
    flat = {"overall": "topDomainsOverall", "own": "topDomainsByOwnBrandCitations"}
    grouped = {
        "engine": ("topDomainsByEngine", "engineId"),
        "competitor": ("topDomainsByCompetitor", "brandName"),
    }
    none = F.lit(None).cast("string")

    def entries(domains: Column, scope: str, member: Column) -> Column:
        return F.coalesce(
            F.transform(
                domains,
                lambda d: F.struct(
                    F.lit(scope).alias("scope"), member.alias("member"), d["domain"].alias("domain"),
                    d["occurrences"].alias("occurrences"),
                    F.coalesce(F.size(d["urls"]), F.lit(0)).alias("url_count"),
                ),
            ),
            F.array(),
        )

    def members(groups: Column, scope: str, label: str) -> Column:
        nested = F.transform(groups, lambda g: entries(g["domains"], scope, g[label]))
        return F.coalesce(F.flatten(nested), F.array())

    lists = [entries(summary[field], scope, none) for scope, field in flat.items()]
    for scope, (field, label) in grouped.items():
        lists.append(members(summary[field], scope, label))
    return payloads.select("brand_id", F.inline(F.concat(*lists)))


def capped_citations(payloads: DataFrame) -> DataFrame:
    """Citation payloads the sender cut at its limits."""
    page = F.col("data.paginationInfo")
    return payloads.where(page["citationsCapped"] | page["brandsCapped"]).select(
        "brand_id", page["returnedCount"].alias("returned_count"), page["totalCount"].alias("total_count"),
        page["maxCitations"].alias("max_citations"), page["maxBrands"].alias("max_brands"),
    )


# --- report timelines ---------------------------------------------------------------------


def _first_filled(container: Column) -> Column:
    """First period, in fixed order, that has timestamps."""
    return F.coalesce(
        *[F.when(F.size(container[p]["timestamps"]) > 0, container[p]) for p in PERIODS]
    )


def _points(series: DataFrame, *carry: str) -> DataFrame:
    """Rows with ``_times`` and ``_metrics`` to one row per timestamp; short arrays give NULL."""
    at = series.select(*carry, "_metrics", F.posexplode("_times").alias("_pos", "_time"))
    return at.select(
        *carry, F.col("_time"),
        *[F.get(F.col("_metrics")[field], F.col("_pos")).alias(name) for field, name in SERIES_MEASURES.items()],
        F.get(F.col("_metrics.brandNotFound"), F.col("_pos")).alias("brand_not_found"),
    )


def report_rows(payloads: DataFrame) -> DataFrame:
    """Own and competitor timelines: one row per brand and timestamp.

    Payload columns: ``brand_id``, ``brand_name``, ``topic_id``, ``topic_name``, ``data``.
    """
    own = F.col("data.ownBrandMetrics")
    own_period = _first_filled(own["historicalData"])
    other_period = _first_filled(F.col("data.competitorTimeSeriesData"))

    def entry(name: Column, is_own: Column, times: Column, metrics: Column) -> Column:
        return F.struct(
            name.alias("brand_name"), is_own.alias("is_own_brand"),
            times.alias("_times"), metrics.alias("_metrics"),
        )

    mine = F.array(
        entry(F.coalesce(own["name"], F.col("brand_name")), F.lit(True), own_period["timestamps"], own_period)
    )
    others = F.transform(
        other_period["competitors"],
        lambda c: entry(
            c["name"], F.coalesce(c["isOwnBrand"], F.lit(False)), other_period["timestamps"], c["metrics"]
        ),
    )
    series = payloads.select(
        F.col("brand_id").alias("owning_brand_id"), "topic_id", "topic_name",
        F.inline(F.concat(mine, F.coalesce(others, F.array()))),
    )
    carry = ["owning_brand_id", "topic_id", "topic_name", "brand_name", "is_own_brand"]
    day = F.substring("_time", 1, 10)
    return _points(series, *carry).select(
        row_uuid().alias("unique_row_id"),
        business_key(F.col("owning_brand_id"), F.col("topic_id"), F.col("brand_name"), day).alias("business_key"),
        "owning_brand_id", "topic_id", "topic_name",
        parse_timestamp("_time").alias("snapshot_time"),
        text_day("_time").alias("snapshot_date"),
        "brand_name", "is_own_brand", *SERIES_MEASURES.values(),
    )


def breakdown_rows(payloads: DataFrame, by: str) -> DataFrame:
    """Own-brand timelines per topic or engine (``by`` is ``topic`` or ``engine``).

    Each member carries its own timestamps; ``member_id`` and ``member_name`` identify it.
    """
    container = F.col(f"data.ownBrandMetrics.{by}MetricsData")
    filled = F.coalesce(*[F.when(F.size(container[p]) > 0, container[p]) for p in PERIODS])
    members = F.transform(
        filled,
        lambda m: F.struct(
            m[f"{by}Id"].alias("member_id"), m[f"{by}Name"].alias("member_name"),
            m["timestamps"].alias("_times"), m.alias("_metrics"),
        ),
    )
    series = payloads.select(F.col("brand_id").alias("owning_brand_id"), F.inline(members))
    return _points(series, "owning_brand_id", "member_id", "member_name").withColumns({
        "snapshot_time": parse_timestamp("_time"), "snapshot_date": text_day("_time"),
    }).drop("_time")


def brand_gaps(payloads: DataFrame) -> DataFrame:
    """Days of the own timeline on which some snapshot did not find the brand."""
    own_period = _first_filled(F.col("data.ownBrandMetrics.historicalData"))
    series = payloads.select(
        F.col("brand_id").alias("owning_brand_id"), own_period["timestamps"].alias("_times"),
        own_period.alias("_metrics"),
    )
    return _points(series, "owning_brand_id").groupBy(
        "owning_brand_id", text_day("_time").alias("snapshot_date")
    ).agg(F.bool_or("brand_not_found").alias("brand_not_found"))


def competitor_summary(payloads: DataFrame) -> DataFrame:
    """Snapshot of all brands of a report, the own brand among them."""
    return payloads.select("brand_id", F.inline("data.competitorMetrics")).select(
        F.col("brand_id").alias("owning_brand_id"), F.col("name").alias("brand_name"),
        F.col("isOwnBrand").alias("is_own_brand"), F.col("latestValue").alias("latest_value"), "trend",
        *[F.col(field).alias(name) for field, name in SNAPSHOT_MEASURES.items()],
    )


# --- sentiment ----------------------------------------------------------------------------


def _polar(words: Column) -> Column:
    """Keyword maps by polarity as one array of (polarity, keyword, details)."""

    def entries(polarity: str) -> Column:
        listed = F.transform(
            F.map_entries(words[polarity]),
            lambda e: F.struct(
                F.lit(polarity).alias("polarity"), e["key"].alias("keyword"), e["value"].alias("details")
            ),
        )
        return F.coalesce(listed, F.array())

    return F.concat(*[entries(polarity) for polarity in ("positive", "neutral", "negative")])


def sentiment_keywords(payloads: DataFrame) -> DataFrame:
    """Keywords per brand: ``source`` is all, web or training; ``engine`` is set for per-engine maps."""
    found = payloads.select("brand_id", F.inline("data.brandSentiments"))
    whole = F.struct(
        F.col("positiveKeywords").alias("positive"), F.col("neutralKeywords").alias("neutral"),
        F.col("negativeKeywords").alias("negative"),
    )
    none = F.lit(None).cast("string")

    def tagged(words: Column, source: str, engine: Column) -> Column:
        return F.transform(
            _polar(words),
            lambda k: F.struct(
                F.lit(source).alias("source"), engine.alias("engine"), k["polarity"].alias("polarity"),
                k["keyword"].alias("keyword"), k["details"].alias("details"),
            ),
        )

    def by_engine(engines: Column, source: str) -> Column:
        nested = F.transform(F.map_entries(engines), lambda e: tagged(e["value"], source, e["key"]))
        return F.coalesce(F.flatten(nested), F.array())

    lists = [tagged(whole, "all", none)]
    for source, field in {"web": "webGroundingKeywords", "training": "trainingDataKeywords"}.items():
        lists += [tagged(F.col(field), source, none), by_engine(F.col(field)["byEngine"], source)]
    return found.select(
        F.col("brand_id").alias("owning_brand_id"), F.col("name").alias("brand_name"),
        F.inline(F.concat(*lists)),
    ).select(
        "owning_brand_id", "brand_name", "source", "engine", "polarity", "keyword",
        F.col("details.count").alias("count"),
        F.arrays_zip(
            F.col("details.executionIds").alias("execution_id"), F.col("details.timestamps").alias("at")
        ).alias("occurrences"),
    )


def keyword_occurrences(keywords: DataFrame) -> DataFrame:
    """One row per keyword occurrence: execution and time, paired by position."""
    carry = [c for c in keywords.columns if c != "occurrences"]
    return keywords.select(*carry, F.inline("occurrences")).withColumn("at", parse_timestamp("at"))


def engine_sentiment(payloads: DataFrame) -> DataFrame:
    """Score sum and count per brand, source and engine."""
    found = payloads.select("brand_id", F.inline("data.brandSentiments"))

    def scores(engines: str, source: str) -> Column:
        listed = F.transform(
            F.map_entries(engines),
            lambda e: F.struct(
                F.lit(source).alias("source"), e["key"].alias("engine"),
                e["value"]["sum"].alias("score_sum"), e["value"]["count"].alias("score_count"),
            ),
        )
        return F.coalesce(listed, F.array())

    both = F.concat(
        scores("webGroundingSentimentByEngine", "web"), scores("trainingDataSentimentByEngine", "training")
    )
    return found.select(
        F.col("brand_id").alias("owning_brand_id"), F.col("name").alias("brand_name"), F.inline(both)
    )


def sentiment_totals(payloads: DataFrame) -> DataFrame:
    """Score sum and count per brand, over all engines."""
    return payloads.select("brand_id", F.inline("data.brandSentiments")).select(
        F.col("brand_id").alias("owning_brand_id"), F.col("name").alias("brand_name"),
        F.col("isOwnBrand").alias("is_own_brand"),
        F.col("totalSentimentScore").alias("score_sum"), F.col("sentimentCount").alias("score_count"),
    )
