"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    return True


def hashable(df: DataFrame) -> list[Column]:
    """The columns whose content a hash can be made of."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if _orderable(f.dataType)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column],
    tiebreak: Sequence[Column] | None = None,
) -> DataFrame:
    """The first row of each key under ``order``; NULL keys form a group of their own.

    Rows that tie under ``order`` are told apart by ``tiebreak``, by default every
    remaining column in schema order (largest first), so reruns keep the same row.
    The rank filter sits directly on the window, so Spark drops all but one row per
    key before the shuffle: a key that owns a third of the table costs one row per
    input split.
    """
    if tiebreak is None:
        tiebreak = [F.desc_nulls_last(f.name) for f in df.schema.fields if _orderable(f.dataType)]
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def last_in_batch(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """Deduplicate a batch by key: the last occurrence in ``sequence`` order wins."""
    return latest_per_key(df, [key], [F.desc_nulls_last(sequence)])


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each group with their position (``position``, from 1).

    ``order`` must be total (end it with a unique column). The limit is applied
    before the shuffle as in :func:`latest_per_key`.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("position", F.row_number().over(window).cast("long"))
    return ranked.where(F.col("position") <= n)
