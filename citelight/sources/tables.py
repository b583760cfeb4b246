"""Parquet tables: layout, loads and merges.

Tables are folders of Parquet files read with an explicit schema, so a column added
to the schema later reads as NULL from older files. A table that is replaced as a whole
has a sub-folder per version; a commit (see :mod:`citelight.sources.commits`) names the
one that counts, and is the last thing a replacing job writes. Until then readers see the old rows,
also if the job fails. The version before stays for those who still read it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..operators.latest import hashable, last_in_batch, latest_per_key
from ..operators.share import join_null_safe
from ..session import staged
from . import commits

STAMP = "etl_loaded_at"


def run_stamp(run_time: datetime) -> Column:
    """The run's time as a timestamp column; a time without zone is taken as UTC."""
    if run_time.tzinfo is None:
        run_time = run_time.replace(tzinfo=timezone.utc)
    return F.lit(run_time.astimezone(timezone.utc).isoformat()).cast("timestamp")


def table_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows now."""
    folder = commits.newest(spark, f"{path}/_commits")[1].get("folder")
    return f"{path}/{folder}" if folder else path


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``; columns its files do not have are NULL."""
    return spark.read.schema(schema).parquet(table_path(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored at ``path`` (one metadata call, no file listing)."""
    return commits.exists(spark, path)


def ensure_table(spark: SparkSession, path: str, schema: StructType, partitions: Sequence[str] = ()) -> bool:
    """Create an empty table unless one exists; says whether it was created."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.partitionBy(*partitions).parquet(path)
    return True


def empty_table(spark: SparkSession, path: str, schema: StructType, partitions: Sequence[str] = ()) -> None:
    """Remove all rows, keeping the table."""
    replace_table(spark.createDataFrame([], schema), path, partitions)


def add_column(spark: SparkSession, table: str, name: str, kind: str) -> None:
    """Add a nullable column to a catalog table."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind})")


# --- layout -------------------------------------------------------------------------------


def laid_out(df: DataFrame, partitions: Sequence[str], cluster: Sequence[str]) -> DataFrame:
    """Rows grouped by partition value and sorted by the clustering columns.

    The rebalance step gathers a partition value in few files but splits one that is
    larger than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several tasks,
    so a day holding a third of the table does not end in one writer. Sorting lets
    Parquet's row-group statistics skip by the clustering columns.
    """
    if partitions:
        df = df.hint("rebalance", *[F.col(c) for c in partitions])
    if partitions or cluster:
        df = df.sortWithinPartitions(*partitions, *cluster)
    return df


def replace_table(df: DataFrame, path: str, partitions: Sequence[str] = (), cluster: Sequence[str] = ()) -> None:
    """Create or replace the table with ``df``, which may read the table itself."""
    spark = df.sparkSession
    number, before = commits.newest(spark, f"{path}/_commits")
    folder = f"v{number + 1}-{uuid.uuid4().hex}"
    laid_out(df, partitions, cluster).write.partitionBy(*partitions).parquet(f"{path}/{folder}")
    commits.commit(spark, f"{path}/_commits", number + 1, {"folder": folder})
    _remove_versions(spark, path, number, before.get("folder"))


def _remove_versions(spark: SparkSession, path: str, number: int, before: str | None) -> None:
    """Delete what is older than version ``number`` in folder ``before``, also rows stored before there were versions."""
    for name in commits.children(spark, path):
        version = re.fullmatch(r"v(\d+)-[0-9a-f]{32}", name)
        old = name != before and int(version[1]) <= number if version else before is not None and name[0] not in "_."
        if old:
            commits.remove(spark, f"{path}/{name}")


# --- loads --------------------------------------------------------------------------------


def append_rows(rows: DataFrame, path: str, run_time: datetime, partitions: Sequence[str] = ()) -> None:
    """Append a batch, every row stamped with the run's time. An empty batch adds nothing."""
    stamped = rows.withColumn(STAMP, run_stamp(run_time))
    stamped.write.mode("append").partitionBy(*partitions).parquet(table_path(rows.sparkSession, path))


def truncate_load(rows: DataFrame, path: str, run_time: datetime) -> bool:
    """Replace a table by a batch stamped ``loaded_at``; an empty batch changes nothing."""
    if rows.isEmpty():
        return False
    replace_table(stringify_nested(rows).withColumn("loaded_at", run_stamp(run_time)), path)
    return True


def overwrite_days(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    schema: StructType,
    run_time: datetime,
    day: str = "snapshot_date",
    owner: str | None = "owning_brand_id",
    cluster: Sequence[str] = (),
) -> None:
    """Replace only the days the batch touches; other history stays.

    Rows without a day belong to the run's day. With ``owner``, the rows other owners
    have on those days are carried over, so a batch of one brand replaces that brand's
    days only. ``owner=None`` replaces whole days, whoever owns their rows. The table
    at ``path`` (partitioned by ``day``) must exist.
    """
    stamp = run_stamp(run_time)
    dated = rows.withColumn(day, F.coalesce(F.col(day), F.to_date(stamp))).withColumn("loaded_at", stamp)
    dated = dated.select(*schema.names)
    if owner is not None:
        dated = staged(dated, "days")
        # Written, so that its size is known and a short list is broadcast, not the table shuffled by day.
        replaced = staged(dated.select(day, owner).distinct(), "days")
        first, last = replaced.agg(F.min(day), F.max(day)).first()
        if first is None:
            return
        # The range prunes partitions; the joins then keep exactly the other owners of touched days.
        stored = read_table(spark, path, schema).where(F.col(day).between(F.lit(first), F.lit(last)))
        kept = join_null_safe(
            stored.join(replaced.select(day), day, "left_semi").select(*schema.names),
            replaced, [day, owner], "left_anti",
        )
        dated = staged(dated.unionByName(kept), "days")
    laid_out(dated, [day], cluster).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(day).parquet(table_path(spark, path))


def new_rows(target: DataFrame, batch: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """Rows of the batch whose key is not in the target yet, one row per key.

    ``sequence`` names the column giving the order in the batch (the last occurrence
    wins); without it the choice is fixed by the row's content.
    """
    fresh = join_null_safe(batch, target.select(key), [key], "left_anti")
    return latest_per_key(fresh, [key], []) if sequence is None else last_in_batch(fresh, key, sequence)


def append_new(
    spark: SparkSession, rows: DataFrame, path: str, schema: StructType, key: str, run_time: datetime
) -> None:
    """Append only rows whose key is not stored yet."""
    fresh = new_rows(read_table(spark, path, schema), rows, key)
    fresh.withColumn("loaded_at", run_stamp(run_time)).write.mode("append").parquet(table_path(spark, path))


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    run_time: Column,
    scope: Column | None = None,
    sequence: str | None = None,
) -> DataFrame:
    """The target after merging a (non-empty) batch.

    Matched rows take every column of the batch, also its NULLs; new rows are added;
    rows missing from the batch get ``is_active = false`` and a new ``loaded_at``, but
    only those ``scope`` (a condition on target columns) covers. Keys repeated in the
    batch are reduced first: the last in ``sequence`` order wins.
    """
    single = latest_per_key(source, [key], []) if sequence is None else last_in_batch(source, key, sequence)
    if sequence is not None and sequence not in target.columns:
        single = single.drop(sequence)
    incoming = set(single.columns)
    old = target.withColumn("_scope", F.lit(True) if scope is None else F.coalesce(scope, F.lit(False)))
    new = single.withColumn("loaded_at", run_time)
    # NULL keys match nothing, but would all be shuffled to one task: a second key from their content spreads them.
    salt = F.when(F.col(key).isNotNull(), F.lit(0))
    salt_of = lambda df: salt.otherwise(F.pmod(F.xxhash64(*hashable(df)), F.lit(4096)))
    old = old.select(F.struct(*[F.col(c) for c in old.columns]).alias("_old"), F.col(key).alias("_old_key"), salt_of(old).alias("_old_salt"))
    new = new.select(F.struct(*[F.col(c) for c in new.columns]).alias("_new"), F.col(key).alias("_new_key"), salt_of(new).alias("_new_salt"))
    merged = old.join(new, (F.col("_old_key") == F.col("_new_key")) & (F.col("_old_salt") == F.col("_new_salt")), "full_outer")
    arrived = F.col("_new").isNotNull()
    gone = ~arrived & F.col("_old._scope")

    def merge_column(name: str) -> Column:
        value = F.col("_old")[name]
        if name == "is_active":
            value = F.when(gone, F.lit(False)).otherwise(value)
        if name == "loaded_at":
            value = F.when(gone, run_time).otherwise(value)
        if name in incoming or name == "loaded_at":
            value = F.when(arrived, F.col("_new")[name]).otherwise(value)
        return value.alias(name)

    return merged.select(*[merge_column(c) for c in target.columns])


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source: DataFrame,
    key: str,
    run_time: datetime,
    scope_keys: str | None = None,
    sequence: str | None = None,
) -> bool:
    """Merge a batch into the table at ``path``; an empty batch changes (and deactivates) nothing.

    ``scope_keys`` limits deactivation to rows whose value in that column occurs in
    the batch: search terms of one brand's batch never deactivate another brand's.
    """
    if source.isEmpty():
        return False
    target = read_table(spark, path, schema)
    scope = None
    if scope_keys is not None:
        # Written, so that its size is known when the join with the target is planned.
        present = staged(source.select(scope_keys).distinct(), "scope").withColumn("_in_batch", F.lit(True))
        target = target.join(present, scope_keys, "left").select(*target.columns, "_in_batch")
        scope = F.col("_in_batch")
    merged = upsert(target, source, key, run_stamp(run_time), scope, sequence)
    replace_table(merged.select(*schema.names), path)
    return True


def stringify_nested(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text; other columns unchanged."""
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (ArrayType, StructType, MapType)) else F.col(f.name)
        for f in df.schema.fields
    ])
