"""Checks on batches and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

PAGE_CAP = 5000  # fixed value: search terms per page


def capped_pages(rows: DataFrame, by: Sequence[str] = ("brand_id",), cap: int = PAGE_CAP) -> DataFrame:
    """Groups whose batch is as large as the page limit: their list may have been cut."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= cap)


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def missing_values(table: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: how many NULLs each required column has."""
    return table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])


def failed_units(quarantined: DataFrame, by: Sequence[str] = ("brand_id",)) -> DataFrame:
    """Payloads that could not be read, per unit."""
    return quarantined.groupBy(*by).agg(F.count(F.lit(1)).alias("payloads"))
