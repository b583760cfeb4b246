"""Latest-state facts and dimensions (L1) and their denormalised form (L2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import iso_week
from ..operators.latest import latest_per_key
from ..operators.lookup import with_dimension
from ..operators.share import share_of_voice
from ..operators.tags import tag_bridge

LOADED = "etl_loaded_at"


# --- L1 -----------------------------------------------------------------------------------


def dim_brands(raw: DataFrame) -> DataFrame:
    """Latest state of each brand; active when part of the newest load day."""
    newest = raw.agg(F.max(F.to_date(LOADED))).scalar()
    return latest_per_key(raw, ["brand_id"], [F.desc_nulls_last(LOADED)]).select(
        "brand_id", "name", "domain", "is_own_brand",
        (F.to_date(LOADED) == newest).alias("is_active"),
        F.col(LOADED).alias("updated_at"),
    )


def dim_search_terms(raw: DataFrame) -> DataFrame:
    """Latest state of each search term; active by its status."""
    return latest_per_key(raw, ["search_term_id"], [F.desc_nulls_last(LOADED)]).select(
        "search_term_id", "brand_id", "query", "engine", "topic_id", "topic_name", "tags", "region", "interval",
        (F.col("status") == "active").alias("is_active"),
        "created_at", "last_execution_time", "next_execution_time",
        F.col(LOADED).alias("updated_at"),
    )


def metric_day() -> Column:
    """Day of a snapshot: its own time, else the load time."""
    return F.to_date(F.coalesce("last_snapshot_at", LOADED))


def latest_snapshots(raw: DataFrame) -> DataFrame:
    """Newest landing row per search term, brand name and ISO week (``snapshot_week``).

    Where one name appears as own brand and as competitor of a term, the own-brand row
    is kept when the times tie.
    """
    weekly = raw.withColumn("snapshot_week", iso_week(metric_day()))
    remaining = [c for c in raw.columns if c not in ("is_own_brand", "last_snapshot_at", LOADED)]
    return latest_per_key(
        weekly,
        ["search_term_id", "brand_name", "snapshot_week"],
        [F.desc_nulls_last("last_snapshot_at"), F.desc_nulls_last(LOADED)],
        [F.desc_nulls_last("is_own_brand"), *[F.desc_nulls_last(c) for c in remaining]],
    )


def snapshot_columns(latest: DataFrame, *more: str) -> DataFrame:
    """Fact columns of the newest snapshots; competitors have no brand id."""
    return latest.select(
        "snapshot_week", metric_day().alias("snapshot_date"), "search_term_id", "brand_name",
        F.when(F.col("is_own_brand"), F.col("brand_id")).alias("brand_id"),
        "is_own_brand", "topic_id", "engine", "visibility_score", "avg_sentiment", "avg_rank", "latest_rank",
        "detection_rate", "top3_rate", "citation_count", "appearances", *more,
    )


def fact_snapshots(raw: DataFrame) -> DataFrame:
    """Newest snapshot per search term, brand name and ISO week, with share of voice.

    Share of voice is computed for every brand, after deduplication. Rows and group
    sums use the same columns of the deduplicating shuffle, so it runs once for both.
    """
    shared = share_of_voice(
        latest_snapshots(raw), "visibility_score", ["search_term_id", "snapshot_week"]
    )
    return snapshot_columns(shared, "ai_share_of_voice")


def fact_citations(raw: DataFrame) -> DataFrame:
    """Newest citation row per brand, term, engine, domain, URL and ISO week of the load."""
    dated = raw.withColumn("snapshot_date", F.to_date(LOADED)).withColumn(
        "snapshot_week", iso_week("snapshot_date")
    )
    keys = [
        "brand_id", "search_term_id", "engine", "domain", F.coalesce("url", F.lit("")), "snapshot_week",
    ]
    return latest_per_key(dated, keys, [F.desc_nulls_last(LOADED)]).select(
        "snapshot_week", "snapshot_date", "search_term_id", "brand_id", "engine", "domain", "url", "occurrences"
    )


def fact_answer_texts(raw: DataFrame) -> DataFrame:
    """One row per execution."""
    return latest_per_key(raw, ["execution_id"], [F.desc_nulls_last(LOADED)]).select(
        "execution_id", "search_term_id", iso_week("executed_at").alias("snapshot_week"), "executed_at", "engine",
        "answer_text",
    )


def report_table(raw: DataFrame) -> DataFrame:
    """Newest row per business key of the report timelines."""
    return latest_per_key(raw, ["business_key"], [F.desc_nulls_last(LOADED)])


# --- L2 -----------------------------------------------------------------------------------


def l2_snapshots(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """Snapshots with the current state of their search term.

    ``topic_id`` is the topic at snapshot time, ``topic_name`` the term's current one.
    """
    joined = with_dimension(facts, terms, "search_term_id", [
        "query", "region", F.col("interval").alias("refresh_interval"),
        F.col("is_active").alias("is_search_term_active"), "last_execution_time", "next_execution_time",
        "topic_name", "tags", F.col("brand_id").alias("owning_brand_id"),
    ])
    return joined.select(
        "snapshot_week", "snapshot_date", "search_term_id", "query", "region", "refresh_interval",
        "is_search_term_active", "last_execution_time", "next_execution_time", "topic_id", "topic_name", "tags",
        "engine", "owning_brand_id", "brand_name", "brand_id", "is_own_brand", "visibility_score",
        "avg_sentiment", "avg_rank", "latest_rank", "detection_rate", "top3_rate", "citation_count",
        "appearances", "ai_share_of_voice",
    )


def l2_search_term_tags(terms: DataFrame) -> DataFrame:
    """Bridge of search terms and tags."""
    return tag_bridge(terms, ["search_term_id", "brand_id", "topic_id", "topic_name", "engine", "query"])


def l2_citations(facts: DataFrame, terms: DataFrame, brands: DataFrame) -> DataFrame:
    """Citations with the current state of their search term and the monitoring brand's name."""
    joined = with_dimension(facts, terms, "search_term_id", ["query", "topic_id", "topic_name", "tags"])
    joined = with_dimension(joined, brands, "brand_id", [F.col("name").alias("brand_name")])
    return joined.select(
        "snapshot_week", "snapshot_date", "search_term_id", "query", "topic_id", "topic_name", "tags",
        "brand_id", "brand_name", "engine", "domain", "url", "occurrences",
    )


def l2_answer_texts(facts: DataFrame, terms: DataFrame) -> DataFrame:
    """Answer texts with the current state of their search term."""
    joined = with_dimension(facts, terms, "search_term_id", ["query", "topic_id", "topic_name", "tags"])
    return joined.select(
        "execution_id", "snapshot_week", "executed_at", "search_term_id", "query", "topic_id", "topic_name",
        "tags", "engine", "answer_text",
    )
