"""Registration of queries and access to the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from ..session import RECOMMENDED

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The input tables of one scale, each read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def clock_free(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values, as the input tables hold them."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(sql: str | None = None, name: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` is the equivalent query over the same tables."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            for setting in ("spark.sql.session.timeZone", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
                spark.conf.set(setting, RECOMMENDED[setting])
            return clock_free(build(Tables(spark, folder)))

        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return build

    return register
