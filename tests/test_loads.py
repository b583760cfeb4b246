from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citelight.sources import commits, freshness, tables

RUN = datetime(2026, 4, 22, 6, tzinfo=timezone.utc)
TARGET = "k string, v string, owner string, is_active boolean, loaded_at timestamp"


def target(spark):
    old = datetime(2026, 4, 1)
    return spark.createDataFrame([
        ("matched", "old", "b1", True, old), ("to_null", "old", "b1", True, old), ("gone", "old", "b1", True, old),
        ("gone_elsewhere", "old", "b2", True, old), ("inactive", "old", "b1", False, old), (None, "null key", "b2", True, old),
    ], TARGET)


def source(spark):
    return spark.createDataFrame([
        ("matched", "first", "b1", True, 1), ("matched", "last", "b1", True, 2), ("to_null", None, "b1", True, 3),
        ("new", "x", "b1", True, 4), ("inactive", "back", "b1", True, 5),
    ], "k string, v string, owner string, is_active boolean, seq int")


def test_upsert(spark):
    merged = tables.upsert(target(spark), source(spark), "k", tables.run_stamp(RUN), scope=F.col("owner") == "b1", sequence="seq")
    got = {r.k: (r.v, r.is_active, r.loaded_at == datetime(2026, 4, 22, 6)) for r in merged.collect()}
    assert got == {
        "matched": ("last", True, True), "to_null": (None, True, True), "new": ("x", True, True),
        "inactive": ("back", True, True), "gone": ("old", False, True),
        "gone_elsewhere": ("old", True, False), None: ("null key", True, False),
    }
    assert merged.columns == target(spark).columns


def test_rows_without_key_are_spread(spark):
    """Each stays a row of its own, and no task gets them all."""
    old = spark.range(4000).selectExpr(
        "IF(id % 2 = 0, NULL, CAST(id AS STRING)) AS k", "CAST(id AS STRING) AS v", "'b1' AS owner", "true AS is_active",
        "TIMESTAMP '2026-04-01' AS loaded_at")
    batch = old.where("k IS NOT NULL").drop("loaded_at")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = tables.upsert(old, batch, "k", tables.run_stamp(RUN))
        per_task = [r["count"] for r in merged.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 2000 and len(per_task) == 4 and max(per_task) < 700
    assert merged.where("k IS NULL AND NOT is_active").count() == 2000 and merged.count() == 4000


def test_upsert_without_scope_deactivates_everywhere(spark):
    merged = tables.upsert(target(spark), source(spark), "k", tables.run_stamp(RUN), sequence="seq")
    assert {r.k for r in merged.where("not is_active").collect()} == {"gone", "gone_elsewhere", None}


def test_upsert_table(spark, tmp_path):
    path = str(tmp_path / "t")
    target(spark).write.parquet(path)
    schema = target(spark).schema
    empty = source(spark).where("false").drop("seq")
    assert not tables.upsert_table(spark, path, schema, empty, "k", RUN)
    assert tables.read_table(spark, path, schema).where("not is_active").count() == 1
    batch = source(spark).where("k <> 'matched' or seq = 2").drop("seq")
    assert tables.upsert_table(spark, path, schema, batch, "k", RUN, scope_keys="owner")
    stored = tables.read_table(spark, path, schema)
    assert stored.count() == 7 and {r.k for r in stored.where("not is_active").collect()} == {"gone"}
    # The same batch again: nothing changes but the load time.
    before = sorted(map(str, stored.drop("loaded_at").collect()))
    tables.upsert_table(spark, path, schema, batch, "k", RUN, scope_keys="owner")
    assert before == sorted(map(str, tables.read_table(spark, path, schema).drop("loaded_at").collect()))


def test_append_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = StructType.fromDDL("id string, v string, loaded_at timestamp")
    tables.ensure_table(spark, path, schema)
    first = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), (None, "1")], "id string, v string")
    tables.append_new(spark, first, path, schema, "id", RUN)
    again = spark.createDataFrame([("b", "9"), ("c", "1"), (None, "9")], "id string, v string")
    tables.append_new(spark, again, path, schema, "id", RUN)
    got = sorted((r.id or "", r.v) for r in tables.read_table(spark, path, schema).collect())
    assert got == [("", "1"), ("a", "1"), ("b", "2"), ("c", "1")]


DATED = "snapshot_date string, owning_brand_id string, v int"


def dated(spark, rows):
    return spark.createDataFrame(rows, DATED).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


@pytest.mark.parametrize("owner, kept", [
    ("owning_brand_id", {("2026-04-01", "b1", 1), ("2026-04-02", "b2", 2), ("2026-04-02", None, 3),
                         ("2026-04-02", "b1", 9), ("2026-04-22", "b1", 7)}),
    (None, {("2026-04-01", "b1", 1), ("2026-04-02", "b1", 9), ("2026-04-22", "b1", 7)}),
])
def test_overwrite_days(spark, tmp_path, owner, kept):
    path = str(tmp_path / "t")
    schema = StructType.fromDDL("snapshot_date date, owning_brand_id string, v int, loaded_at timestamp")
    tables.ensure_table(spark, path, schema, ["snapshot_date"])
    first = [("2026-04-01", "b1", 1), ("2026-04-02", "b1", 2), ("2026-04-02", "b2", 2), ("2026-04-02", None, 3)]
    for batch in (first, [("2026-04-02", "b1", 9), (None, "b1", 7)], []):  # an empty batch touches nothing
        tables.overwrite_days(spark, dated(spark, batch), path, schema, RUN, owner=owner)
    stored = tables.read_table(spark, path, schema)
    assert {(str(r.snapshot_date), r.owning_brand_id, r.v) for r in stored.collect()} == kept


def test_a_large_day_is_split_over_tasks(spark, tmp_path):
    """A day holding most rows must not end in one file when it exceeds the advisory size."""
    path = str(tmp_path / "t")
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("2026-04-01")).otherwise(F.lit("2026-04-02")).cast("date").alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.replace_table(rows, path, ["day"], ["v"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
    stored = tables.read_table(spark, path, rows.schema)
    files = stored.select("day", F.input_file_name().alias("f")).distinct()
    per_day = {str(r.day): r["count"] for r in files.groupBy("day").count().collect()}
    assert per_day["2026-04-01"] > 3
    assert stored.count() == 300_000


def test_replace_reads_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    read = lambda: tables.read_table(spark, path, spark.range(1).schema)
    tables.replace_table(read().where("id < 4"), path)
    before = read()
    assert before.count() == 4
    tables.replace_table(read().where("id < 2"), path)
    # Who still reads the version before can go on; the one before that is gone.
    assert (read().count(), before.count()) == (2, 4)
    tables.replace_table(read(), path)
    assert [name[:2] for name in commits.children(spark, path) if name[0] == "v"] == ["v2", "v3"]


def test_a_replacing_job_that_fails_leaves_the_table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.range(1).schema
    tables.replace_table(spark.range(10), path)
    broken = spark.range(0, 1000, 1, 8).selectExpr("IF(id = 999, raise_error('midway'), id) AS id")
    with pytest.raises(Exception, match="midway"):
        tables.replace_table(broken, path)
    assert tables.read_table(spark, path, schema).count() == 10
    with pytest.raises(Exception, match="midway"):
        tables.truncate_load(broken, path, RUN)
    tables.replace_table(spark.range(3), path)
    assert tables.read_table(spark, path, schema).count() == 3


def test_of_two_writers_one_is_told(spark, tmp_path):
    folder = str(tmp_path / "c" / "_commits")
    assert commits.newest(spark, folder) == (0, {})
    commits.commit(spark, folder, 1, {"by": "a"})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, folder, 1, {"by": "b"})
    assert commits.newest(spark, folder) == (1, {"by": "a"})
    for number in range(2, 12):
        commits.commit(spark, folder, number, {"by": str(number)})
    assert commits.newest(spark, folder) == (11, {"by": "11"})
    assert len(commits.children(spark, folder)) == commits.KEPT + 1


def test_tables_exist_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = StructType.fromDDL("id bigint, day date")
    assert tables.ensure_table(spark, path, schema, ["day"])
    assert tables.read_table(spark, path, schema).count() == 0
    spark.sql("SELECT 1L AS id, DATE '2026-04-01' AS day").write.mode("append").partitionBy("day").parquet(path)
    assert not tables.ensure_table(spark, path, schema, ["day"])
    assert tables.read_table(spark, path, schema).count() == 1
    tables.empty_table(spark, path, schema, ["day"])
    assert tables.read_table(spark, path, schema).count() == 0


def test_added_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    wider = StructType.fromDDL("id bigint, created_at timestamp")
    assert [r.created_at for r in tables.read_table(spark, path, wider).collect()] == [None] * 3
    spark.range(2).write.mode("overwrite").saveAsTable("citelight_added")
    tables.add_column(spark, "citelight_added", "note", "string")
    assert spark.table("citelight_added").columns == ["id", "note"]
    assert spark.table("citelight_added").where("note is null").count() == 2
    spark.sql("DROP TABLE citelight_added")


def test_truncate_load_keeps_the_table_for_an_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("SELECT 1 AS id, array('ř', 'b') AS tags")
    assert tables.truncate_load(rows, path, RUN)
    assert not tables.truncate_load(rows.where("false"), path, RUN)
    stored = spark.read.parquet(tables.table_path(spark, path)).first()
    assert stored.tags == '["ř","b"]' and stored.loaded_at == datetime(2026, 4, 22, 6)


def test_freshness_gate(spark):
    times = {"equal": 5, "newer": 6, "older": 4, "unstored": 5, "unknown": None, "stored_unknown": 5}
    day = lambda n: None if n is None else datetime(2026, 4, n)
    payload = spark.createDataFrame([(b, day(n)) for b, n in times.items()], "brand_id string, payload_max timestamp")
    stored = spark.createDataFrame(
        [(b, day(None if b == "stored_unknown" else 5)) for b in times if b != "unstored"],
        "brand_id string, stored_max timestamp")
    fresh = freshness.fresh_brands(payload, stored)
    assert {r.brand_id for r in fresh.collect()} == {"newer", "unstored", "unknown", "stored_unknown"}
    assert freshness.fresh_brands(payload, stored, force=True).count() == len(times)
    batch = spark.createDataFrame([("newer", 1), ("newer", 2), ("older", 3)], "brand_id string, v int")
    assert {r.v for r in freshness.gate(batch, fresh).collect()} == {1, 2}


@pytest.mark.parametrize("ran, kept, loads", [(6, 5, True), (5, 5, False), (4, 5, False), (None, 5, True), (5, None, True)])
def test_global_gate(spark, ran, kept, loads):
    day = lambda n: None if n is None else datetime(2026, 4, n)
    terms = spark.createDataFrame([(day(ran),), (None,)], "last_execution_time timestamp")
    stored = spark.createDataFrame([(day(kept),)], "last_snapshot_at timestamp")
    assert spark.range(1).where(freshness.anything_new(terms, stored)).isEmpty() is not loads


def test_windows(spark):
    import datetime as dt

    as_of = spark.sql("SELECT DATE '2026-04-22' AS day")
    got = [(str(r.iso_start), str(r.iso_end)) for r in freshness.week_windows(as_of, "day", 3).orderBy("iso_start").collect()]
    assert got == [("2026-04-06", "2026-04-12"), ("2026-04-13", "2026-04-19"), ("2026-04-20", "2026-04-26")]
    today = dt.date(2026, 4, 22)
    assert freshness.report_window(today) == (dt.date(2026, 4, 15), today)
    assert freshness.report_window(today, dt.date(2026, 1, 1)) == (dt.date(2026, 1, 1), today)
    assert freshness.report_window(today, dt.date(2026, 1, 1), dt.date(2026, 2, 1))[1] == dt.date(2026, 2, 1)
