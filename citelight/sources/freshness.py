"""High-water marks, freshness gates and load windows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import week_monday
from ..session import staged

REPORT_DAYS = 7  # fixed value: trailing days a daily report load covers


def stored_marks(snapshots: DataFrame) -> DataFrame:
    """Newest stored snapshot time per brand (``stored_max``)."""
    return snapshots.groupBy("brand_id").agg(F.max("last_snapshot_at").alias("stored_max"))


def fresh_brands(payload_marks: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Brands to load: their payload is newer than what is stored, or either time is unknown.

    ``payload_marks`` has ``brand_id`` and ``payload_max``. ``force`` (backfill) keeps all.
    """
    if force:
        return payload_marks.select("brand_id")
    both = payload_marks.join(stored, "brand_id", "left")
    stale = F.col("payload_max") <= F.col("stored_max")
    return both.where(~F.coalesce(stale, F.lit(False))).select("brand_id")


def gate(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of the brands to load.

    The list of brands is written to the shared folder first: its size is then known
    when the join is planned, and a short list is broadcast without moving the batch.
    """
    return batch.join(staged(fresh, "fresh-brands"), "brand_id", "left_semi")


def anything_new(terms: DataFrame, stored: DataFrame) -> Column:
    """One condition for a whole run: some term ran after the newest stored snapshot.

    Also true when either side has no time. Use it in ``where``; both maxima are
    scalar subqueries.
    """
    ran = terms.agg(F.max("last_execution_time")).scalar()
    kept = stored.agg(F.max("last_snapshot_at")).scalar()
    return F.coalesce(ran > kept, F.lit(True))


def freshness_report(snapshots: DataFrame, loaded: str = "loaded_at") -> DataFrame:
    """Newest snapshot time and newest load time."""
    return snapshots.agg(
        F.max("last_snapshot_at").alias("last_snapshot"), F.max(loaded).alias("last_etl_run")
    )


def week_windows(as_of: DataFrame, day: str, weeks: int) -> DataFrame:
    """The last ``weeks`` Monday-to-Sunday windows up to the day in the one-row ``as_of``."""
    monday = week_monday(day)
    starts = F.sequence(F.date_sub(monday, 7 * (weeks - 1)), monday, F.expr("interval 7 days"))
    return as_of.select(F.explode(starts).alias("iso_start")).withColumn("iso_end", F.date_add("iso_start", 6))


def report_window(run_day: date, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """Days a report load covers: the backfill range, else the trailing week."""
    if start is not None:
        return start, end or run_day
    return run_day - timedelta(days=REPORT_DAYS), run_day


def in_window(day: Column, window: tuple[date, date]) -> Column:
    """Whether a day lies in a window, both ends included."""
    return day.between(F.lit(window[0]), F.lit(window[1]))
