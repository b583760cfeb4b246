"""Whole runs: landed payloads to raw tables, raw tables to L1 and L2.

A warehouse is a folder with one sub-folder per table. Landing tables hold the rows of
committed loads (:mod:`citelight.sources.loads`), so landed files are loaded once, under the run they belong
to. Facts are stored by ``snapshot_week``, the unit their keys and shares are computed in, and sorted by day
and the filter columns, so a refresh replaces exactly the weeks it recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import iso_week, week_monday
from ..operators.share import join_null_safe
from ..session import staged
from ..sources import commits, flatten, tables
from ..sources.freshness import anything_new, fresh_brands, gate, in_window, stored_marks
from ..sources.loads import LOAD, Ledger, Load
from ..sources.payloads import CORRUPT, read_payloads, split_corrupt
from . import layers


@dataclass(frozen=True)
class Warehouse:
    """Table paths below one root."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.root)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if table in schemas.RAW_TABLES:
            return self.landed(spark, table).drop(LOAD)
        return tables.read_table(spark, self.path(table), schemas.TABLES[table])

    def landed(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows of a landing table with the load they came by."""
        return self.ledger(spark).rows(self.path(table), schemas.RAW_TABLES[table])


@dataclass
class RunResult:
    """Unreadable or incomplete payloads by endpoint. They are set aside; the others are loaded."""

    failed: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not any(self.failed.values())


# Sort order of the facts within a week.
CLUSTER = {
    "l1_fact_snapshots": ("snapshot_date", "is_own_brand", "engine"),
    "l1_fact_citations": ("snapshot_date", "engine", "domain"),
    "l1_fact_answer_texts": ("executed_at", "engine"),
    "l2_snapshots": ("snapshot_date", "is_own_brand", "engine", "topic_id"),
    "l2_citations": ("snapshot_date", "engine", "domain"),
    "l2_answer_texts": ("executed_at", "engine"),
}


def create_tables(spark: SparkSession, warehouse: Warehouse) -> None:
    """Create the tables that do not exist yet."""
    for table, schema in schemas.TABLES.items():
        partitions = ("snapshot_week",) if table in schemas.FACTS else ()
        tables.ensure_table(spark, warehouse.path(table), schema, partitions)


def reset(spark: SparkSession, warehouse: Warehouse) -> None:
    """Empty every table, keeping it, and forget the loads: landed files can be loaded anew."""
    warehouse.ledger(spark).forget()
    for table, schema in schemas.TABLES.items():
        if table not in schemas.RAW_TABLES:
            partitions = ("snapshot_week",) if table in schemas.FACTS else ()
            tables.empty_table(spark, warehouse.path(table), schema, partitions)
    number, _ = commits.newest(spark, _refreshes(warehouse))
    if number:
        commits.commit(spark, _refreshes(warehouse), number + 1, {"loads": []})


# --- extract ------------------------------------------------------------------------------


@dataclass
class _Extract:
    """One run's files on their way into the tables."""

    spark: SparkSession
    landing: str
    warehouse: Warehouse
    load: Load
    result: RunResult

    def payloads(
        self, endpoint: str, schema: StructType, parameters: Sequence[str] = ("brand_id",)
    ) -> DataFrame | None:
        """Readable payloads of an endpoint in this load; None if it has no files of it.

        The JSON is parsed once into a columnar copy in the shared folder, which all
        flatteners read. Unreadable and incomplete documents go to a quarantine table.
        """
        self.result.failed.setdefault(endpoint, 0)
        if endpoint not in self.load.endpoints:
            return None
        path = f"{self.landing.rstrip('/')}/{endpoint}"
        own = self.load.rows_of(read_payloads(self.spark, path, schema, (*parameters, "run"), named=True), endpoint)
        parsed = staged(own, f"payloads-{endpoint}")
        good, bad = split_corrupt(parsed, endpoint)
        failures = bad.count()
        self.result.failed[endpoint] += failures
        if failures:
            self.append(bad.select(*parameters, CORRUPT), f"quarantine_{endpoint}")
        return good

    def append(self, rows: DataFrame, table: str) -> None:
        """Rows for a landing or quarantine table, stamped with the run's time."""
        if table in schemas.RAW_TABLES:
            rows = rows.select(*[c for c in schemas.RAW_TABLES[table].names if c != tables.STAMP])
        self.load.append(rows.withColumn(tables.STAMP, tables.run_stamp(self.load.time)), self.warehouse.path(table))


def load_raw(
    spark: SparkSession, landing: str, warehouse: Warehouse, run_time: datetime, backfill: bool = False
) -> RunResult:
    """Landed payloads that no load has taken yet into the landing tables, run by run.

    Search-term reports of brands without a newer snapshot are skipped, unless
    ``backfill``. Brands, search terms and citations are always loaded. ``run_time`` is the time of files without a run.
    """
    create_tables(spark, warehouse)
    result = RunResult()
    for load in warehouse.ledger(spark).pending(landing, "raw", _RAW_ENDPOINTS, run_time):
        run = _Extract(spark, landing, warehouse, load, result)
        for endpoint, schema, parameters, flattened, table in (
            ("brands", schemas.BRANDS, (), flatten.brands, "raw_brands"),
            ("search_terms", schemas.SEARCH_TERMS, ("brand_id",), flatten.search_terms, "raw_search_terms"),
            ("citations", schemas.CITED_URLS, ("brand_id",), flatten.citations, "raw_citations"),
        ):
            payloads = run.payloads(endpoint, schema, parameters)
            if payloads is not None:
                run.append(flattened(payloads), table)
        reports = run.payloads("term_report", schemas.TERM_REPORT)
        if reports is not None:
            # Against the runs before this one; the gate writes its list of brands when it is built.
            marks = stored_marks(warehouse.read(spark, "raw_brand_snapshots"))
            fresh = fresh_brands(flatten.latest_payload_snapshot(reports), marks, force=backfill)
            reports = gate(reports, fresh)
            run.append(flatten.brand_snapshots(reports), "raw_brand_snapshots")
            run.append(flatten.answer_texts(reports), "raw_answer_texts")
        load.commit()
    return result


_RAW_ENDPOINTS = ("brands", "search_terms", "term_report", "citations")


def load_report(
    spark: SparkSession, landing: str, warehouse: Warehouse, run_time: datetime,
    window: tuple[date, date] | None = None, backfill: bool = False,
) -> RunResult:
    """New report timelines of active topics into their landing table, then into the deduplicated table.

    ``window`` (see :func:`citelight.sources.freshness.report_window`) limits the days
    loaded; without it all days of the payloads are. A ``backfill`` also takes files that are loaded already, once per
    window. A brand's name and topics are those of the run, or of the newest run before it that has them.
    """
    create_tables(spark, warehouse)
    result = RunResult()
    ledger = warehouse.ledger(spark)
    pipeline = f"report {window}" if backfill else "report"
    for load in ledger.pending(landing, pipeline, ("brands", "topics", "report"), run_time):
        run = _Extract(spark, landing, warehouse, load, result)
        for endpoint, schema, parameters, flattened, table in (
            ("brands", schemas.BRANDS, (), flatten.brands, "report_brands"),
            ("topics", schemas.TOPICS, ("brand_id",), flatten.active_topics, "report_topics"),
        ):
            payloads = run.payloads(endpoint, schema, parameters)
            if payloads is not None:
                run.append(flattened(payloads), table)
        reports = run.payloads("report", schemas.TIMELINES, ("brand_id", "topic_id"))
        if reports is not None:
            held = [*ledger.committed(), load.id]
            names = _latest_lists(ledger, warehouse.path("report_brands"), "brand_id string, name string", held, load.time)
            names = names.withColumnRenamed("name", "brand_name")
            active = _latest_lists(
                ledger, warehouse.path("report_topics"), "brand_id string, topic_id string, topic_name string", held, load.time
            )
            rows = flatten.report_rows(reports.join(active, ["brand_id", "topic_id"]).join(names, "brand_id"))
            if window is not None:
                rows = rows.where(in_window(F.col("snapshot_date"), window))
            run.append(rows, "l0_report")
        load.commit()
    tables.replace_table(
        layers.report_table(warehouse.read(spark, "l0_report")), warehouse.path("l1_report"),
        cluster=("snapshot_date", "topic_id"),
    )
    return result


def _latest_lists(ledger: Ledger, path: str, columns: str, loads: list[str], until: datetime) -> DataFrame:
    """Of a small table the rows each brand has by its newest run up to a time; empty if there are none."""
    schema = StructType.fromDDL(columns)
    if not commits.exists(ledger.spark, path):
        return ledger.spark.createDataFrame([], schema)
    stored = ledger.rows(path, StructType(list(schema.fields)).add(tables.STAMP, "timestamp"), loads)
    stored = stored.where(F.col(tables.STAMP) <= tables.run_stamp(until))
    newest = stored.groupBy("brand_id").agg(F.max(tables.STAMP).alias(tables.STAMP))
    return stored.join(newest, ["brand_id", tables.STAMP], "left_semi").select(*schema.names).distinct()


def load_by_date(spark: SparkSession, landing: str, warehouse: Warehouse, run_time: datetime) -> RunResult:
    """The direct load without landing tables, run by run.

    Brands and search terms are merged (missing ones are deactivated, search terms
    only within the brands of the batch); when some term ran after the newest stored
    snapshot, snapshots and citations replace the touched days of their brand and new
    answer texts are appended. Each step gives the same table when a run that failed is repeated.
    """
    targets = {
        "brands": schemas.CURRENT_BRANDS, "search_terms": schemas.CURRENT_SEARCH_TERMS,
        "brand_snapshots": schemas.DATED_BRAND_SNAPSHOTS, "answer_texts": schemas.DATED_ANSWER_TEXTS,
        "citations": schemas.DATED_CITATIONS,
    }
    by_day = ("brand_snapshots", "citations")
    for table, schema in targets.items():
        partitions = ("snapshot_date",) if table in by_day else ()
        tables.ensure_table(spark, warehouse.path(table), schema, partitions)
    result = RunResult()
    for load in warehouse.ledger(spark).pending(landing, "by-date", _RAW_ENDPOINTS, run_time):
        _load_run_by_date(spark, warehouse, _Extract(spark, landing, warehouse, load, result), targets)
        load.commit()
    return result


def _load_run_by_date(spark: SparkSession, warehouse: Warehouse, run: _Extract, targets: dict[str, StructType]) -> None:
    time = run.load.time
    run_day = F.to_date(tables.run_stamp(time))
    brands = run.payloads("brands", schemas.BRANDS, ())
    if brands is not None:
        rows = flatten.brands(brands).withColumn("is_active", F.lit(True))
        tables.upsert_table(spark, warehouse.path("brands"), targets["brands"], rows, "brand_id", time)

    payloads = run.payloads("search_terms", schemas.SEARCH_TERMS)
    if payloads is None:
        return
    terms = flatten.search_terms(payloads)
    current = terms.withColumn("is_active", F.coalesce(F.col("status") == "active", F.lit(False))).select(
        *[c for c in targets["search_terms"].names if c != "loaded_at"]
    )
    tables.upsert_table(
        spark, warehouse.path("search_terms"), targets["search_terms"], current, "search_term_id", time,
        scope_keys="brand_id",
    )
    stored = tables.read_table(spark, warehouse.path("brand_snapshots"), targets["brand_snapshots"])
    if spark.range(1).where(anything_new(terms, stored)).isEmpty():
        return
    reports = run.payloads("term_report", schemas.TERM_REPORT)
    if reports is not None:
        # Answer texts first: their ids make a repeated run add none, while snapshots decide whether a run is repeated.
        tables.append_new(
            spark, flatten.answer_texts(reports).drop("brand_id"), warehouse.path("answer_texts"),
            targets["answer_texts"], "execution_id", time,
        )
    cited = run.payloads("citations", schemas.CITED_URLS)
    if cited is not None:
        tables.overwrite_days(
            spark, flatten.dated_citations(cited, run_day), warehouse.path("citations"), targets["citations"], time,
            owner="brand_id", cluster=("brand_id", "engine", "domain"),
        )
    if reports is not None:
        tables.overwrite_days(
            spark, flatten.dated_brand_snapshots(reports, run_day), warehouse.path("brand_snapshots"),
            targets["brand_snapshots"], time, cluster=("is_own_brand", "engine"),
        )


# --- build --------------------------------------------------------------------------------


def build_dimensions(spark: SparkSession, warehouse: Warehouse) -> None:
    """Rebuild the dimensions and the tag bridge."""
    tables.replace_table(
        layers.dim_brands(warehouse.read(spark, "raw_brands")), warehouse.path("l1_dim_brands")
    )
    tables.replace_table(
        layers.dim_search_terms(warehouse.read(spark, "raw_search_terms")), warehouse.path("l1_dim_search_terms")
    )
    bridge = layers.l2_search_term_tags(warehouse.read(spark, "l1_dim_search_terms"))
    tables.replace_table(bridge, warehouse.path("l2_search_term_tags"), cluster=("tag",))


def _write_fact(df: DataFrame, warehouse: Warehouse, table: str) -> None:
    """Replace a whole fact."""
    tables.replace_table(df, warehouse.path(table), ["snapshot_week"], CLUSTER[table])


def _write_weeks(df: DataFrame, warehouse: Warehouse, table: str, weeks: DataFrame) -> None:
    """Replace ``weeks`` (a written list) of a fact by the rows of ``df``; the files of other weeks stay."""
    spark = df.sparkSession
    folder = tables.table_path(spark, warehouse.path(table))
    rows = staged(df, "weeks")
    tables.laid_out(rows, ["snapshot_week"], CLUSTER[table]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("snapshot_week").parquet(folder)
    # Weeks that have lost their last row; a row per week at most.
    empty = join_null_safe(weeks, rows.select("snapshot_week").distinct(), ["snapshot_week"], "left_anti")
    for row in empty.collect():
        name = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
        commits.remove(spark, f"{folder}/snapshot_week={name}")


def _build_l2(spark: SparkSession, warehouse: Warehouse) -> None:
    """Join all weeks again: L2 shows the current state of the dimensions."""
    terms = warehouse.read(spark, "l1_dim_search_terms")
    brands = warehouse.read(spark, "l1_dim_brands")
    snapshots = layers.l2_snapshots(warehouse.read(spark, "l1_fact_snapshots"), terms)
    cited = layers.l2_citations(warehouse.read(spark, "l1_fact_citations"), terms, brands)
    answers = layers.l2_answer_texts(warehouse.read(spark, "l1_fact_answer_texts"), terms)
    _write_fact(snapshots, warehouse, "l2_snapshots")
    _write_fact(cited, warehouse, "l2_citations")
    _write_fact(answers, warehouse, "l2_answer_texts")


# Facts whose key has the week: landing table, builder and the columns the day comes from (first one set).
_WEEKLY_FACTS = (
    ("l1_fact_snapshots", "raw_brand_snapshots", layers.fact_snapshots, ("last_snapshot_at", tables.STAMP)),
    ("l1_fact_citations", "raw_citations", layers.fact_citations, (tables.STAMP,)),
)


def _refreshes(warehouse: Warehouse) -> str:
    return f"{warehouse.path('loads')}/_refreshes"


def full_refresh(spark: SparkSession, warehouse: Warehouse) -> None:
    """Recompute L1 and L2 from all landing rows."""
    loads = warehouse.ledger(spark).committed()
    number, _ = commits.newest(spark, _refreshes(warehouse))
    build_dimensions(spark, warehouse)
    for fact, source, build, _ in _WEEKLY_FACTS:
        _write_fact(build(warehouse.read(spark, source)), warehouse, fact)
    answers = layers.fact_answer_texts(warehouse.read(spark, "raw_answer_texts"))
    _write_fact(answers, warehouse, "l1_fact_answer_texts")
    _build_l2(spark, warehouse)
    commits.commit(spark, _refreshes(warehouse), number + 1, {"loads": loads})


def _not_before(clocks: Sequence[str], first: Column) -> Column:
    """The day given by ``clocks`` is at or after ``first``, written so that Parquet can skip by it."""
    clock, *others = clocks
    hit = F.col(clock) >= first
    return hit | (F.col(clock).isNull() & _not_before(others, first)) if others else hit


def rows_of_touched_weeks(raw: DataFrame, clocks: Sequence[str], changed: Column) -> tuple[DataFrame, DataFrame]:
    """All landing rows of the ISO weeks that ``changed`` rows lie in, and these weeks."""
    day = F.to_date(F.coalesce(*clocks))
    touched = staged(
        raw.where(changed).select(iso_week(day).alias("snapshot_week"), week_monday(day).alias("_monday")).distinct(),
        "touched-weeks",
    )
    # Two values: rows of the undated week (if touched) and the first Monday.
    undated, first = touched.agg(F.count_if(F.col("snapshot_week").isNull()), F.min("_monday")).first()
    start = tables.run_stamp(datetime.combine(first, datetime.min.time(), timezone.utc)) if first else F.lit(None)
    within = _not_before(clocks, start) if first else F.lit(False)
    if undated:
        within = within | F.coalesce(*clocks).isNull()
    dated = raw.where(within).withColumn("snapshot_week", iso_week(day))
    weeks = touched.select("snapshot_week")
    return join_null_safe(dated, weeks, ["snapshot_week"], "left_semi").drop("snapshot_week"), weeks


def moved_answers(raw: DataFrame, fact: DataFrame, changed: Column) -> tuple[DataFrame, DataFrame]:
    """The new content of all weeks of ``fact`` that ``changed`` landing rows bring a change to, and these weeks.

    An execution may come again with another time and so move to another week, or be given its time later. The fact itself
    says which week an execution lies in now: that week loses the row and the new one gains it. Among the
    landing rows of the executions that came again, only those stamped no earlier than the changed rows can be the newest.
    """
    keys = ["execution_id"]
    came = raw.where(changed)
    again = staged(came.select(*keys).distinct(), "executions")
    recent = raw.where(F.col(tables.STAMP) >= came.agg(F.min(tables.STAMP)).scalar()).drop(LOAD)
    newest = staged(layers.fact_answer_texts(join_null_safe(recent, again, keys, "left_semi")), "answers")
    lay = join_null_safe(fact.select(*keys, "snapshot_week"), again, keys, "left_semi")
    weeks = lay.select("snapshot_week").unionByName(newest.select("snapshot_week")).distinct()
    weeks = staged(weeks, "touched-weeks")
    kept = join_null_safe(join_null_safe(fact, weeks, ["snapshot_week"], "left_semi"), again, keys, "left_anti")
    return kept.unionByName(newest.select(*fact.columns)), weeks


def incremental_refresh(spark: SparkSession, warehouse: Warehouse, since: datetime | None = None) -> None:
    """Recompute only the weeks that the loads since the last refresh touch; the result equals a full refresh.

    ``since`` names the changed rows by the time of their run instead. Snapshots and citations have the week in
    their key, so whole weeks are exact; an execution's row may move between weeks (:func:`moved_answers`). A run that is
    loaded late counts by its load, however old its time is.
    """
    loads = warehouse.ledger(spark).committed()
    number, state = commits.newest(spark, _refreshes(warehouse))
    if since is None:
        fresh = sorted(set(loads) - set(state.get("loads", [])))
        changed = F.col(LOAD).isin(fresh) if fresh else F.lit(False)
    else:
        changed = F.col(tables.STAMP) >= tables.run_stamp(since)
    build_dimensions(spark, warehouse)
    for fact, source, build, clocks in _WEEKLY_FACTS:
        rows, weeks = rows_of_touched_weeks(warehouse.landed(spark, source), clocks, changed)
        _write_weeks(build(rows.drop(LOAD)), warehouse, fact, weeks)
    fact = warehouse.read(spark, "l1_fact_answer_texts")
    rows, weeks = moved_answers(warehouse.landed(spark, "raw_answer_texts"), fact, changed)
    _write_weeks(rows, warehouse, "l1_fact_answer_texts", weeks)
    _build_l2(spark, warehouse)
    commits.commit(spark, _refreshes(warehouse), number + 1, {"loads": loads})
