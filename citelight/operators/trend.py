"""Moving averages and change against the previous period.

Both first reduce to one row per key and day or week, so a window partition holds
at most as many rows as the calendar has days or weeks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import mean


def daily_moving_average(
    df: DataFrame, key: Sequence[str], day: str, value: str, days: int = 7,
) -> DataFrame:
    """Daily mean of ``value`` and its mean over the last ``days`` rows (``<value>_ma``).

    The moving mean is over daily means, by rows: days without data are skipped.
    """
    daily = df.groupBy(*key, day).agg(mean(F.col(value)).alias(value))
    return moving_average(daily, key, day, value, days)


def moving_average(
    df: DataFrame, key: Sequence[str], order: str, value: str, rows: int = 7,
) -> DataFrame:
    """Mean over the current and the ``rows - 1`` preceding rows of each key.

    ``df`` holds one row per key and ``order`` value (a report timeline does).
    """
    window = Window.partitionBy(*key).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumn(f"{value}_ma", mean(F.col(value), over=window))


def change_from_previous(
    df: DataFrame, key: Sequence[str], period: str, values: dict[str, bool]
) -> DataFrame:
    """Change of each value against the key's previous row, with a direction label.

    ``values`` maps a column to whether a larger number is better. Larger-is-better
    columns are labelled ``up``/``down``, the others (ranks) ``improved``/``declined``;
    no change or no previous row has no label. ``df`` holds one row per key and period.
    """
    window = Window.partitionBy(*key).orderBy(period)
    for name, larger_is_better in values.items():
        change = F.col(name) - F.lag(name).over(window)
        df = df.withColumn(f"{name}_change", change)
        df = df.withColumn(f"{name}_direction", direction(F.col(f"{name}_change"), larger_is_better))
    return df


def direction(change: Column, larger_is_better: bool = True) -> Column:
    """Label of a change."""
    rising, falling = ("up", "down") if larger_is_better else ("declined", "improved")
    return F.when(change > 0, F.lit(rising)).when(change < 0, F.lit(falling))


def weekly_values(
    df: DataFrame, key: Sequence[str], week: str, values: Sequence[str]
) -> DataFrame:
    """Weekly mean of each value per key."""
    return df.groupBy(*key, week).agg(*[mean(F.col(v)).alias(v) for v in values])


