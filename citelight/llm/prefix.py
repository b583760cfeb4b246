"""Totals of all rows before each row of an ordered table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged


def running_totals(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with a column per entry of ``sums``: its total over all rows before the row in ``order``.

    The rows are range-partitioned and each range is summed on its own; only the ranges'
    totals, one row per partition, meet in one task. Rows equal in ``order`` lie in one
    range, in no particular order.
    """
    pieces = staged(df.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()), "pieces")
    totals = pieces.groupBy("_piece").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_piece", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.join(starts, "_piece").select(
        *df.columns, *[(F.col(f"_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()]
    )
