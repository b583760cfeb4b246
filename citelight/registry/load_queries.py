"""Loads: what a table holds after a load, read back from the files it wrote.

Stored and incoming rows are overlapping date ranges of one table, together the
whole table. Tables are written below the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..functions import iso_week, week_monday
from ..plans import layers, runs
from ..plans.runs import Warehouse
from ..session import scratch_path
from ..sources import freshness, tables
from . import bindings as b
from .base import Tables, query

RUN = datetime(2024, 2, 1, 6, tzinfo=timezone.utc)


def _dated(t: Tables) -> DataFrame:
    """events with their day and an owner."""
    return t.events.select(
        "event_id", F.to_date("ts").alias("snapshot_date"),
        F.concat(F.lit("ws-"), F.length(F.col("user_id").cast("string")).cast("string")).alias("owning_brand_id"),
        "event_type", "value",
    )


DATED = """dated AS (SELECT event_id, ts::DATE AS snapshot_date, 'ws-' || length(user_id::VARCHAR)::VARCHAR
  AS owning_brand_id, event_type, value FROM events)"""


def _stored(t: Tables) -> DataFrame:
    return _dated(t).where(F.col("snapshot_date") <= F.lit("2024-01-20").cast("date"))


def _incoming(t: Tables) -> DataFrame:
    """From day 10 on; on shared days one owner only, with another value."""
    shared = F.col("snapshot_date") <= F.lit("2024-01-20").cast("date")
    batch = _dated(t).where(F.col("snapshot_date") >= F.lit("2024-01-10").cast("date"))
    return batch.where(~shared | (F.col("owning_brand_id") == "ws-2")).withColumn("value", F.col("value") + 1000)


@query(f"""WITH {DATED} SELECT event_id, snapshot_date, owning_brand_id, event_type, value, true AS stamped FROM dated
UNION ALL SELECT event_id, snapshot_date, owning_brand_id, event_type, value + 1000, true FROM dated
WHERE snapshot_date > DATE '2024-01-20' OR (snapshot_date >= DATE '2024-01-10' AND owning_brand_id = 'ws-2')""")
def load_append(t: Tables) -> DataFrame:
    """Two appended batches, each row stamped with its run."""
    path = scratch_path(t.spark, "append")
    tables.append_rows(_dated(t), path, datetime(2024, 1, 21, tzinfo=timezone.utc))
    tables.append_rows(_incoming(t), path, RUN)
    stored = t.spark.read.parquet(path)
    return stored.withColumn("stamped", F.col(tables.STAMP).isNotNull()).drop(tables.STAMP)


@query("""SELECT event_id, ts::DATE AS day, value FROM events""")
def load_append_dedup(t: Tables) -> DataFrame:
    """Append only ids not stored yet, from a batch that overlaps the table and repeats rows."""
    rows = t.events.select("event_id", F.to_date("ts").alias("day"), "value")
    stored = rows.where(F.col("day") <= F.lit("2024-01-20").cast("date"))
    batch = rows.where(F.col("day") >= F.lit("2024-01-10").cast("date"))
    path = scratch_path(t.spark, "append-dedup")
    stored.withColumn("loaded_at", tables.run_stamp(RUN)).write.parquet(path)
    schema = t.spark.read.parquet(path).schema
    tables.append_new(t.spark, batch.unionByName(batch), path, schema, "event_id", RUN)
    return t.spark.read.schema(schema).parquet(path).drop("loaded_at")


def _overwritten(t: Tables, owner: str | None) -> DataFrame:
    path = scratch_path(t.spark, "overwrite")
    schema = _dated(t).withColumn("loaded_at", tables.run_stamp(RUN)).schema
    tables.ensure_table(t.spark, path, schema, ["snapshot_date"])
    for batch in (_stored(t), _incoming(t)):
        tables.overwrite_days(t.spark, batch, path, schema, RUN, owner=owner, cluster=("event_type",))
    return tables.read_table(t.spark, path, schema).drop("loaded_at")


@query(f"""WITH {DATED} SELECT event_id, snapshot_date, owning_brand_id, event_type,
  CASE WHEN snapshot_date > DATE '2024-01-20' OR (snapshot_date >= DATE '2024-01-10' AND owning_brand_id = 'ws-2')
    THEN value + 1000 ELSE value END AS value FROM dated""")
def load_partition_overwrite(t: Tables) -> DataFrame:
    """Replace the touched days of one owner; other days and owners stay."""
    return _overwritten(t, "owning_brand_id")


@query(f"""WITH {DATED} SELECT event_id, snapshot_date, owning_brand_id, event_type,
  CASE WHEN snapshot_date >= DATE '2024-01-10' THEN value + 1000 ELSE value END AS value FROM dated
WHERE snapshot_date < DATE '2024-01-10' OR snapshot_date > DATE '2024-01-20' OR owning_brand_id = 'ws-2'""")
def load_day_overwrite(t: Tables) -> DataFrame:
    """Replace whole touched days: other owners' rows of those days go."""
    return _overwritten(t, None)


@query("""SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.price ELSE t.price END AS price,
  coalesce(s.owner, t.owner) AS owner,
  CASE WHEN s.k IS NOT NULL THEN true WHEN t.owner <> '5-LOW' THEN false ELSE true END AS is_active
FROM (SELECT o_orderkey AS k, o_totalprice AS price, o_orderpriority AS owner FROM orders WHERE o_orderstatus <> 'P') t
FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_totalprice < 200000 THEN o_totalprice * 2 END AS price,
  o_orderpriority AS owner FROM orders WHERE o_orderstatus <> 'F') s ON t.k = s.k""")
def load_upsert(t: Tables) -> DataFrame:
    """Matched rows updated (also to NULL), new ones added, missing ones deactivated within the scope."""
    rows = t.orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("owner"),
        "o_orderstatus", F.lit(True).alias("is_active"), tables.run_stamp(RUN).alias("loaded_at"),
    )
    target = rows.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    source = rows.where("o_orderstatus <> 'F'").drop("o_orderstatus", "loaded_at").withColumn(
        "price", F.when(F.col("price") < 200000, F.col("price") * 2)
    )
    merged = tables.upsert(target, source, "k", tables.run_stamp(RUN), scope=F.col("owner") != "5-LOW")
    return merged.select("k", "price", "owner", "is_active")


@query("""SELECT o_orderkey, o_totalprice FROM orders""")
def load_truncate(t: Tables) -> DataFrame:
    """A table replaced by its newest batch."""
    path = scratch_path(t.spark, "truncate")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    tables.truncate_load(rows.withColumn("o_totalprice", F.lit(0.0)), path, RUN)
    tables.truncate_load(rows, path, RUN)
    tables.truncate_load(rows.where(F.lit(False)), path, RUN)  # an empty batch changes nothing
    return tables.read_table(t.spark, path, rows.schema)


@query("""SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS day, strftime(l_shipdate, '%G-%V') AS week,
  l_returnflag, l_extendedprice FROM lineitem""")
def replaced_by_week(t: Tables) -> DataFrame:
    """Create-or-replace: stored by week, sorted within, read back."""
    path = scratch_path(t.spark, "by-week")
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), iso_week("l_shipdate").alias("week"),
        "l_returnflag", "l_extendedprice",
    )
    tables.replace_table(rows, path, ["week"], ["day", "l_returnflag"])
    return tables.read_table(t.spark, path, rows.schema)


@query("SELECT n_nationkey, n_name, NULL::VARCHAR AS note FROM nation UNION ALL SELECT r_regionkey, r_name, 'new' FROM region")
def added_column(t: Tables) -> DataFrame:
    """A column added later is NULL in older files."""
    path = scratch_path(t.spark, "added-column")
    t.nation.select("n_nationkey", "n_name").write.parquet(path)
    later = t.region.select(
        F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name"), F.lit("new").alias("note")
    )
    later.write.mode("append").parquet(path)
    return tables.read_table(t.spark, path, later.schema)


# --- runs ---------------------------------------------------------------------------------


def _landed_orders(t: Tables) -> DataFrame:
    """A payload per order, of the run that saw its state, and all orders once more in a third run."""
    run = F.when(F.col("o_orderstatus") == "F", F.lit("2024-01-01T06-00-00")).otherwise(F.lit("2024-01-02T06-00-00"))
    term = F.expr("""
        named_struct('id', CAST(o_orderkey AS STRING), 'term', concat('order ', o_orderkey),
          'aiSearchEngines', array(o_orderpriority), 'status', o_orderstatus, 'executionsAmount', o_custkey)
    """)
    document = F.to_json(F.named_struct(F.lit("data"), F.named_struct(F.lit("searchTerms"), F.array(term))))
    return t.orders.select(
        F.concat(F.lit("b"), F.substring("o_orderpriority", 1, 1)).alias("brand_id"), document.alias("value"),
        F.explode(F.array(run, F.lit("2024-01-03T06-00-00"))).alias("run"),
    )


@query("""WITH o AS (SELECT 'b' || left(o_orderpriority, 1) AS brand_id, o_orderkey::VARCHAR AS search_term_id,
  'order ' || o_orderkey AS query, o_orderpriority AS engine, o_orderstatus AS status, o_custkey AS executions_amount FROM orders)
SELECT *, CASE status WHEN 'F' THEN TIMESTAMP '2024-01-01 06:00:00' ELSE TIMESTAMP '2024-01-02 06:00:00' END AS loaded FROM o
UNION ALL SELECT *, TIMESTAMP '2024-01-03 06:00:00' FROM o""")
def loaded_runs(t: Tables) -> DataFrame:
    """Three runs: the last is loaded before the other two arrive side by side; repeated loads change nothing."""
    root = scratch_path(t.spark, "runs")
    house, landed = Warehouse(f"{root}/house"), _landed_orders(t)
    later = F.col("run") == "2024-01-03T06-00-00"
    for rows in (landed.where(later), landed.where(~later)):
        rows.write.mode("append").partitionBy("brand_id", "run").text(f"{root}/landing/search_terms")
        for _ in range(2):
            runs.load_raw(t.spark, f"{root}/landing", house, RUN)
    return house.read(t.spark, "raw_search_terms").select(
        "brand_id", "search_term_id", "query", "engine", "status", "executions_amount", F.col(tables.STAMP).alias("loaded")
    )


def _executions(t: Tables, moved: bool) -> DataFrame:
    """Orders as executions. Every third one comes again: moved by some days, given its time, or losing it."""
    key, clock = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    first = F.when(key % 7 != 0, clock)
    again = F.when(key % 5 != 0, F.timestamp_add("DAY", (key % 11).cast("int"), clock))
    return t.orders.where(key % 3 == 0 if moved else F.lit(True)).select(
        F.lit("b1").alias("brand_id"), F.col("o_custkey").cast("string").alias("search_term_id"),
        key.cast("string").alias("execution_id"), (again if moved else first).alias("executed_at"),
        F.col("o_orderpriority").alias("engine"), F.lit("again" if moved else "first").alias("answer_text"),
    )


@query("""WITH o AS (SELECT o_orderkey, o_custkey::VARCHAR AS search_term_id, o_orderkey::VARCHAR AS execution_id, o_orderpriority AS engine,
  CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + (o_orderkey % 11) * INTERVAL 1 DAY END
    WHEN o_orderkey % 7 <> 0 THEN o_orderdate END::TIMESTAMP AS executed_at,
  CASE WHEN o_orderkey % 3 = 0 THEN 'again' ELSE 'first' END AS answer_text FROM orders)
SELECT execution_id, search_term_id, strftime(executed_at, '%G-%V') AS snapshot_week, executed_at, engine, answer_text FROM o""")
def refreshed_answers(t: Tables) -> DataFrame:
    """An incremental refresh after executions moved between weeks, got or lost their time."""
    house = Warehouse(scratch_path(t.spark, "refresh"))
    runs.create_tables(t.spark, house)
    raw = house.path("raw_answer_texts")
    for moved, day in ((False, 1), (True, 2)):
        rows = _executions(t, moved).withColumn(tables.STAMP, F.lit(f"2024-02-0{day} 06:00:00").cast("timestamp"))
        house.ledger(t.spark).append({raw: rows})
        runs.incremental_refresh(t.spark, house)
    return house.read(t.spark, "l1_fact_answer_texts")


@query("""SELECT coalesce(s.k, t.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.price ELSE t.price END AS price,
  coalesce(s.owner, t.owner) AS owner,
  (s.k IS NOT NULL OR t.owner NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderpriority < '3')) AS is_active
FROM (SELECT o_orderkey AS k, o_totalprice AS price, o_orderpriority AS owner FROM orders WHERE o_orderstatus <> 'P') t
FULL JOIN (SELECT o_orderkey AS k, o_totalprice * 2 AS price, o_orderpriority AS owner FROM orders
  WHERE o_orderstatus <> 'F' AND o_orderpriority < '3') s ON t.k = s.k""")
def upserted_table(t: Tables) -> DataFrame:
    """Merge into a stored table: rows of the owners in the batch that are missing from it are deactivated, twice over."""
    rows = t.orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("owner"),
        F.lit(True).alias("is_active"), tables.run_stamp(RUN).alias("loaded_at"), "o_orderstatus",
    )
    path, stored = scratch_path(t.spark, "upsert"), rows.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    tables.replace_table(stored, path)
    batch = rows.where("o_orderstatus <> 'F' AND owner < '3'").withColumn("price", F.col("price") * 2)
    batch = batch.drop("o_orderstatus", "loaded_at")
    for _ in range(2):
        tables.upsert_table(t.spark, path, stored.schema, batch, "k", RUN, scope_keys="owner")
    return tables.read_table(t.spark, path, stored.schema).drop("loaded_at")


# --- freshness and windows ----------------------------------------------------------------

GATE = f"""{b.SNAP}, marks AS (SELECT brand_name AS brand_id, max(last_snapshot_at) AS m FROM snap GROUP BY ALL),
stored AS (SELECT brand_id, CASE brand_id WHEN 'click' THEN m WHEN 'view' THEN m - INTERVAL 1 DAY
  WHEN 'error' THEN m + INTERVAL 1 DAY WHEN 'signup' THEN NULL END AS m FROM marks WHERE brand_id <> 'purchase')"""


@query(f"""WITH {GATE} SELECT search_term_id, brand_id, last_snapshot_at, visibility_score
FROM (SELECT * EXCLUDE (brand_id), brand_name AS brand_id FROM snap)
WHERE brand_id IN (SELECT p.brand_id FROM marks p LEFT JOIN stored s ON p.brand_id = s.brand_id
  WHERE p.m IS NULL OR s.m IS NULL OR p.m > s.m)""")
def freshness_gate(t: Tables) -> DataFrame:
    """Rows of brands whose payload is newer than stored: equal, newer, older, unknown and new brands."""
    batch = b.snapshots(t).withColumn("brand_id", F.col("brand_name"))
    marks = batch.groupBy("brand_id").agg(F.max("last_snapshot_at").alias("payload_max"))
    name = F.col("brand_id")
    kept = (
        F.when(name == "click", F.col("payload_max"))
        .when(name == "view", F.col("payload_max") - F.expr("interval 1 day"))
        .when(name == "error", F.col("payload_max") + F.expr("interval 1 day"))
    )
    stored = marks.where(name != "purchase").select("brand_id", kept.alias("stored_max"))
    return freshness.gate(batch, freshness.fresh_brands(marks, stored)).select(
        "search_term_id", "brand_id", "last_snapshot_at", "visibility_score"
    )


@query("""SELECT 'older' AS stored, o_orderkey FROM orders
WHERE (SELECT max(o_orderdate) FROM orders) > (SELECT max(o_orderdate) - INTERVAL 1 DAY FROM orders)
UNION ALL SELECT 'equal', o_orderkey FROM orders
WHERE (SELECT max(o_orderdate) FROM orders) > (SELECT max(o_orderdate) FROM orders)
UNION ALL SELECT 'unknown', o_orderkey FROM orders""")
def global_gate(t: Tables) -> DataFrame:
    """All or nothing: load when any term ran after the newest stored snapshot, or none is known."""
    terms = t.orders.select("o_orderkey", F.col("o_orderdate").alias("last_execution_time"))
    clock = F.col("last_execution_time")
    cases = {
        "older": clock - F.expr("interval 1 day"), "equal": clock, "unknown": F.lit(None).cast("timestamp_ntz"),
    }
    parts = [
        terms.where(freshness.anything_new(terms, terms.select(kept.alias("last_snapshot_at"))))
        .select(F.lit(case).alias("stored"), "o_orderkey")
        for case, kept in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {b.SNAP} SELECT max(last_snapshot_at) AS last_snapshot, max(etl_loaded_at) AS last_etl_run FROM snap""")
def freshness_report(t: Tables) -> DataFrame:
    return freshness.freshness_report(b.snapshots(t), layers.LOADED)


@query("""WITH w AS (SELECT (date_trunc('week', max(ts))::DATE - 7 * g.i::INTEGER)::DATE AS iso_start FROM events,
  generate_series(0, 3) g(i) GROUP BY g.i)
SELECT iso_start, (iso_start + 6)::DATE AS iso_end, count(*) AS rows FROM w JOIN events
  ON date_trunc('week', ts)::DATE = iso_start GROUP BY ALL""")
def week_windows(t: Tables) -> DataFrame:
    """The last four Monday-to-Sunday windows of the data, with the rows each would load."""
    as_of = t.events.agg(F.max("ts").alias("ts"))
    windows = freshness.week_windows(as_of, "ts", 4)
    loaded = t.events.groupBy(week_monday("ts").alias("iso_start")).agg(F.count(F.lit(1)).alias("rows"))
    return windows.join(loaded, "iso_start").select("iso_start", "iso_end", "rows")


@query("""SELECT 'daily' AS mode, event_id FROM events WHERE ts::DATE BETWEEN DATE '2024-01-14' AND DATE '2024-01-21'
UNION ALL SELECT 'backfill', event_id FROM events WHERE ts::DATE BETWEEN DATE '2024-01-03' AND DATE '2024-01-21'""")
def report_window(t: Tables) -> DataFrame:
    """Rows a daily report load and a backfill cover."""
    today = date(2024, 1, 21)
    modes = {
        "daily": freshness.report_window(today),
        "backfill": freshness.report_window(today, start=date(2024, 1, 3)),
    }
    parts = [
        t.events.where(freshness.in_window(F.to_date("ts"), window)).select(F.lit(mode).alias("mode"), "event_id")
        for mode, window in modes.items()
    ]
    return parts[0].unionByName(parts[1])
