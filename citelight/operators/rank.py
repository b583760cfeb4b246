"""RANK within a group of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..session import staged
from .share import attach_group_values, join_null_safe

def rank_in_group(df: DataFrame, group: Sequence[str], by: str, out: str = "rank") -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY by DESC)``, NULLs last, without ever holding a whole group in one task.

    Equal values are counted first, so ties collapse. The counts are sorted across
    the cluster by range, which cuts a large group into consecutive pieces; they are
    written out once so that the pieces stay fixed. A row's rank is one plus the rows
    in earlier pieces of its group plus the larger values in its own piece.
    """
    counts = df.groupBy(*group, by).agg(F.count(F.lit(1)).alias("_n"))
    pieces = staged(
        counts.repartitionByRange(*group, F.desc_nulls_last(by)).withColumn("_piece", F.spark_partition_id()),
        "rank",
    )
    # One row per group and piece: a group has at most as many rows here as the sort has partitions.
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*group, "_piece").agg(F.sum("_n").alias("_size"))
        .select(*group, "_piece", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = (
        Window.partitionBy(*group, "_piece").orderBy(F.desc_nulls_last(by))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    above = pieces.withColumn("_above", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranks = join_null_safe(above, starts, [*group, "_piece"], "inner").select(
        *group, by, (F.col("_before") + F.col("_above") + 1).alias(out)
    )
    return attach_group_values(df, ranks, [*group, by])
