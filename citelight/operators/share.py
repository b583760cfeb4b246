"""Share of voice."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import safe_divide, total


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other; the right side's keys are dropped."""
    other = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, match, how).drop(*[f"_r_{k}" for k in keys])


def attach_group_values(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of per-group values back to the rows of the groups (NULL keys match).

    ``groups`` has one row per group. At run time adaptive execution broadcasts it if it is small; else it is
    shuffled, and the rows of a hot group are dealt to several tasks that each read the group's one row.
    """
    return join_null_safe(df, groups, keys, "left")


def share_of_voice(df: DataFrame, value: str, within: Sequence[str], out: str = "ai_share_of_voice") -> DataFrame:
    """Each row's ``value`` over the sum of ``value`` in its group; NULL for a zero sum.

    The group sums are aggregated first (partial sums before the shuffle) and joined
    back; a window over the group would put all rows of a hot group in one task.
    """
    sums = df.groupBy(*within).agg(total(F.col(value)).alias("_sum"))
    joined = attach_group_values(df, sums, within)
    return joined.withColumn(out, safe_divide(F.col(value), F.col("_sum"))).drop("_sum")
