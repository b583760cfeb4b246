"""Entity-attribute-value form of the metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import iso_week, rescale_percent, rescale_sentiment, run_id

# Metric type -> source column and scale.
PERCENT, SENTIMENT, PLAIN = "percent", "sentiment", "plain"
METRICS = {
    "VISIBILITY": ("visibility_score", PERCENT),
    "SENTIMENT": ("avg_sentiment", SENTIMENT),
    "POSITION_RANK": ("avg_rank", PLAIN),
    "DETECTION_RATE": ("detection_rate", PERCENT),
    "TOP3_RATE": ("top3_rate", PERCENT),
    "CITATION_COUNT": ("citation_count", PLAIN),
}
# Fixed value: detection rate from which a brand counts as recommended.
RECOMMENDED_FROM = 0.8
# Labels of a sentiment on the -1..1 scale.
POSITIVE, NEUTRAL, NEGATIVE = "POSITIVE", "NEUTRAL", "NEGATIVE"


def _scaled(source: str, scale: str) -> Column:
    value = F.col(source).cast("double")
    if scale == PERCENT:
        return rescale_percent(value)
    if scale == SENTIMENT:
        return rescale_sentiment(value)
    return value


def prompt_runs(snapshots: DataFrame) -> DataFrame:
    """Snapshots with the id of their run: term and ISO week of the snapshot."""
    return snapshots.withColumn(
        "run_id", run_id(F.col("search_term_id"), iso_week(F.col("last_snapshot_at")))
    )


def unpivot_metrics(runs: DataFrame) -> DataFrame:
    """One row per run, brand and metric that has a value, with a repeatable ``metric_id``.

    ``runs`` carries ``run_id``, ``brand_name``, ``is_own_brand`` and the six metric columns.
    """
    wide = runs.select(
        "run_id", "brand_name", "is_own_brand",
        *[_scaled(source, scale).alias(kind) for kind, (source, scale) in METRICS.items()],
    )
    long = wide.unpivot(
        ["run_id", "brand_name", "is_own_brand"], list(METRICS), "metric_type", "metric_value"
    ).where(F.col("metric_value").isNotNull())
    return long.withColumn(
        "metric_id", F.concat_ws("_", "run_id", F.coalesce("brand_name", F.lit("None")), "metric_type")
    )


def label_metrics(metrics: DataFrame) -> DataFrame:
    """Add ``metric_label``: the sign of a sentiment as a word, NULL for other metrics."""
    value = F.col("metric_value")
    label = F.when(value > 0, POSITIVE).when(value < 0, NEGATIVE).otherwise(NEUTRAL)
    return metrics.withColumn("metric_label", F.when(F.col("metric_type") == "SENTIMENT", label))


def recommendations(metrics: DataFrame) -> DataFrame:
    """``RECOMMENDATION`` rows (1.0 or 0.0) from the detection rate."""
    flagged = (F.col("metric_value") >= RECOMMENDED_FROM).cast("double")
    return metrics.where(F.col("metric_type") == "DETECTION_RATE").select(
        "run_id", "brand_name", "is_own_brand",
        F.lit("RECOMMENDATION").alias("metric_type"), flagged.alias("metric_value"),
    )


def fill_defaults(prompts: DataFrame, products: dict[str, str]) -> DataFrame:
    """First enrichment of prompts: product by topic and default dimensions.

    Only prompts whose ``source`` is empty are filled; edited prompts stay as they are.
    """
    product = F.lit(None).cast("string")
    for topic, name in products.items():
        product = F.when(F.col("topic_id") == topic, F.lit(name)).otherwise(product)
    # Defaults of a prompt nobody has classified yet.
    defaults = {"product": product, "funnel": F.lit("Think"), "type": F.lit("inform"), "source": F.lit("Custom")}
    empty = F.col("source").isNull()
    return prompts.withColumns(
        {name: F.when(empty, value).otherwise(F.col(name)) for name, value in defaults.items()}
    )


def entity_type(is_own_brand: Column) -> Column:
    """``OWN_BRAND`` or ``COMPETITOR``."""
    return F.when(is_own_brand, F.lit("OWN_BRAND")).otherwise(F.lit("COMPETITOR"))
