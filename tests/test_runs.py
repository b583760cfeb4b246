from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

import samples
from citelight import schemas
from citelight.plans import runs
from citelight.plans.runs import Warehouse
from citelight.sources import tables


def at(day, hour=6):
    return datetime(2026, 4, day, hour, tzinfo=timezone.utc)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def landing(tmp_path):
    root = str(tmp_path / "landing")
    samples.land_all(root)
    return root


def test_extract_and_build(spark, tmp_path, landing):
    house = Warehouse(str(tmp_path / "house"))
    assert runs.load_raw(spark, landing, house, at(22)).ok
    count = lambda t: house.read(spark, t).count()
    assert [count(t) for t in schemas.RAW_TABLES] == [2, 4, 6, 2, 5, 0]

    # A repeated run finds nothing to do.
    runs.load_raw(spark, landing, house, at(23), backfill=True)
    assert [count(t) for t in schemas.RAW_TABLES] == [2, 4, 6, 2, 5, 0]
    # Same payloads from another extract: the gate skips both brands' snapshots and texts, the rest is appended.
    second = str(tmp_path / "second")
    samples.land_all(second, run="2026-04-23T06-00-00")
    runs.load_raw(spark, second, house, at(30))
    assert [count(t) for t in schemas.RAW_TABLES] == [4, 8, 6, 2, 10, 0]
    assert house.read(spark, "raw_brands").agg(F.max("etl_loaded_at")).first()[0].day == 23
    # A backfill loads regardless.
    samples.land_all(second, run="2026-04-24")
    runs.load_raw(spark, second, house, at(30), backfill=True)
    assert count("raw_brand_snapshots") == 12

    runs.full_refresh(spark, house)
    assert [count(t) for t in schemas.FACTS] == [6, 5, 2, 6, 5, 2]
    shares = {
        (r.search_term_id, r.brand_name): r.ai_share_of_voice
        for r in house.read(spark, "l2_snapshots").collect()
    }
    assert shares[("t1", "Rival")] == pytest.approx(0.6)
    assert shares[("t2", "Rival")] is None  # the only score is zero
    own = house.read(spark, "l2_snapshots").where("search_term_id = 't9'").first()
    assert (own.owning_brand_id, own.brand_id, own.query) == ("b2", "b2", "cards")
    assert house.read(spark, "l2_snapshots").where("brand_name = 'Rival' and brand_id is not null").isEmpty()
    assert rows(house.read(spark, "l2_search_term_tags").select("search_term_id", "tag")) == [
        "Row(search_term_id='t1', tag='north')", "Row(search_term_id='t1', tag='top funnel')",
        "Row(search_term_id='t3', tag='dup')", "Row(search_term_id='t3', tag='dup')",
    ]
    for table, schema in schemas.FACTS.items():
        assert set(house.read(spark, table).columns) == set(schema.names)

    runs.reset(spark, house)
    assert [count(t) for t in schemas.TABLES] == [0] * len(schemas.TABLES)


def test_built_tables_match_their_schemas(spark, tmp_path):
    from citelight.plans import layers

    house = Warehouse(str(tmp_path / "house"))
    runs.create_tables(spark, house)
    read = lambda t: house.read(spark, t)
    built = {
        "l1_dim_brands": layers.dim_brands(read("raw_brands")),
        "l1_dim_search_terms": layers.dim_search_terms(read("raw_search_terms")),
        "l1_fact_snapshots": layers.fact_snapshots(read("raw_brand_snapshots")),
        "l1_fact_citations": layers.fact_citations(read("raw_citations")),
        "l1_fact_answer_texts": layers.fact_answer_texts(read("raw_answer_texts")),
        "l1_report": layers.report_table(read("l0_report")),
        "l2_snapshots": layers.l2_snapshots(read("l1_fact_snapshots"), read("l1_dim_search_terms")),
        "l2_search_term_tags": layers.l2_search_term_tags(read("l1_dim_search_terms")),
        "l2_citations": layers.l2_citations(
            read("l1_fact_citations"), read("l1_dim_search_terms"), read("l1_dim_brands")),
        "l2_answer_texts": layers.l2_answer_texts(read("l1_fact_answer_texts"), read("l1_dim_search_terms")),
    }
    for table, df in built.items():
        assert df.schema.simpleString() == schemas.TABLES[table].simpleString(), table


def test_unreadable_payload_is_set_aside(spark, tmp_path, landing):
    samples.land(landing, "term_report", '{"data": {"searchTerms": [', brand_id="b3")
    house = Warehouse(str(tmp_path / "house"))
    result = runs.load_raw(spark, landing, house, at(22))
    assert not result.ok and result.failed["term_report"] == 1
    assert house.read(spark, "raw_brand_snapshots").count() == 6
    bad = spark.read.parquet(house.path("quarantine_term_report")).collect()
    assert [r.brand_id for r in bad] == ["b3"] and "searchTerms" in bad[0]._corrupt_record


def test_incomplete_payloads_are_set_aside(spark, tmp_path, landing):
    """A term without id fails its payload; the other brands' payloads are loaded."""
    samples.land(landing, "term_report", {"data": {"searchTerms": [
        {"searchTermId": "t7", "ownBrand": samples.brand("X", 1)}, {"ownBrand": samples.brand("Y", 1)}]}}, brand_id="b3")
    samples.land(landing, "term_report", {"data": {"searchTerms": [
        {"searchTermId": "t8", "answerTexts": [{"answerText": "no id"}]}]}}, brand_id="b4")
    samples.land(landing, "term_report", {"data": {}}, brand_id="b5")  # no list is an empty report
    samples.land(landing, "search_terms", {"data": {}}, brand_id="b3")
    house = Warehouse(str(tmp_path / "house"))
    failed = runs.load_raw(spark, landing, house, at(22)).failed
    assert failed == {"brands": 0, "search_terms": 1, "term_report": 2, "citations": 0}
    assert house.read(spark, "raw_brand_snapshots").count() == 6
    kept = spark.read.parquet(house.path("quarantine_term_report")).collect()
    assert sorted(r.brand_id for r in kept) == ["b3", "b4"] and all("searchTerm" in r._corrupt_record for r in kept)


def test_reports_and_refreshes_skip_what_they_do_not_need(spark, plan_of, tmp_path, landing):
    from citelight.plans import reports

    house = Warehouse(str(tmp_path / "house"))
    runs.load_raw(spark, landing, house, at(22))
    runs.full_refresh(spark, house)
    as_of = F.lit("2026-04-22").cast("date")
    facts = house.read(spark, "l2_snapshots")
    assert "(snapshot_week#" in plan_of(reports.in_week(facts, as_of)).split("PartitionFilters: [")[1].split("]")[0]
    for plan, first in (
        (plan_of(reports.recent(facts, "snapshot_date", as_of)), "2026-13"), (plan_of(reports.top_terms(facts, as_of)), "2026-17"),
        (plan_of(reports.topic_breakdown(facts, as_of)), "2026-17"),
    ):
        folders = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert first in folders and "2026-17" in folders
    assert "GreaterThanOrEqual(snapshot_date,2026-03-23)" in plan_of(reports.recent(facts, "snapshot_date", as_of))
    touched, _ = runs.rows_of_touched_weeks(
        house.read(spark, "raw_brand_snapshots"), ("last_snapshot_at", "etl_loaded_at"),
        F.col("etl_loaded_at") >= tables.run_stamp(at(21)))
    plan = plan_of(touched)
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(last_snapshot_at,2026-04-20" in pushed and "IsNull(last_snapshot_at)" in pushed


def test_incremental_refresh_equals_full(spark, tmp_path, landing):
    house = Warehouse(str(tmp_path / "house"))
    runs.load_raw(spark, landing, house, at(22))
    runs.full_refresh(spark, house)
    # A correction moves t1 to another day of the same week; a new week arrives for t2.
    later = spark.createDataFrame(
        [("b1", "t1", "chatgpt_gui", "p1", "Loans", "2026-04-23 06:00:00", "Rival", False, 45.0),
         ("b1", "t2", "", None, None, "2026-04-28 06:00:00", "Rival", False, 5.0),
         ("b1", "t3", "", None, None, None, "Late", False, 5.0)],
        "brand_id string, search_term_id string, engine string, topic_id string, topic_name string,"
        " last_snapshot_at string, brand_name string, is_own_brand boolean, visibility_score double",
    ).withColumn("last_snapshot_at", F.to_timestamp("last_snapshot_at"))
    stored = later.select(*[
        F.col(f.name) if f.name in later.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.RAW_TABLES["raw_brand_snapshots"].fields if f.name != tables.STAMP
    ]).withColumn(tables.STAMP, tables.run_stamp(at(29)))
    house.ledger(spark).append({house.path("raw_brand_snapshots"): stored})
    runs.incremental_refresh(spark, house, at(29))
    fast = {t: rows(house.read(spark, t)) for t in schemas.FACTS}
    moved = house.read(spark, "l1_fact_snapshots").where("search_term_id = 't1' and brand_name = 'Rival'").collect()
    assert [str(r.snapshot_date) for r in moved] == ["2026-04-23"]
    runs.full_refresh(spark, house)
    assert fast == {t: rows(house.read(spark, t)) for t in schemas.FACTS}


def test_refresh_with_nothing_new_changes_nothing(spark, tmp_path, landing):
    house = Warehouse(str(tmp_path / "house"))
    runs.load_raw(spark, landing, house, at(22))
    runs.full_refresh(spark, house)
    before = {t: rows(house.read(spark, t)) for t in schemas.FACTS}
    runs.incremental_refresh(spark, house, at(25))
    assert before == {t: rows(house.read(spark, t)) for t in schemas.FACTS}


def test_report_run(spark, tmp_path, landing):
    house = Warehouse(str(tmp_path / "house"))
    assert runs.load_report(spark, landing, house, at(15)).ok
    samples.land(landing, "report", samples.report(["2026-04-14", "2026-04-21"], [25, 26], {"Rival": [41]}),
                 brand_id="b1", topic_id="p1")
    runs.load_report(spark, landing, house, at(22))
    got = {
        (str(r.snapshot_date), r.brand_name): r.visibility_score
        for r in house.read(spark, "l1_report").collect()
    }
    # Topic p2 has no search terms, so its report is not loaded.
    assert set(got) == {(d, b) for d in ("2026-04-07", "2026-04-14", "2026-04-21") for b in ("Bank One", "Rival")}
    assert got[("2026-04-21", "Rival")] is None  # series shorter than its timestamps


def test_load_by_date(spark, tmp_path, landing):
    house = Warehouse(str(tmp_path / "house"))
    assert runs.load_by_date(spark, landing, house, at(22)).ok
    read = lambda t, s: tables.read_table(spark, house.path(t), s)
    snaps = read("brand_snapshots", schemas.DATED_BRAND_SNAPSHOTS)
    assert snaps.count() == 6
    unnamed = snaps.where("search_term_id = 't3'").first()
    assert (unnamed.brand_name, str(unnamed.snapshot_date), unnamed.snapshot_week) == ("unknown", "2026-04-22", "2026-17")
    terms = {r.search_term_id: r.is_active for r in read("search_terms", schemas.CURRENT_SEARCH_TERMS).collect()}
    assert terms == {"t1": True, "t2": False, "t3": False, "t9": True}

    # Next run: brand b1's list without t1; b2 has no payload, so its term stays active.
    second = str(tmp_path / "second")
    samples.land(second, "brands", samples.BRANDS)
    samples.land(second, "search_terms", {"data": {"searchTerms": [
        {"id": "t2", "term": "loan", "status": "active", "lastExecutionTime": "2026-05-01T00:00:00Z"}]}}, brand_id="b1")
    samples.land(second, "term_report", samples.REPORT_B1, brand_id="b1")
    samples.land(second, "citations", samples.CITATIONS_B1, brand_id="b1")
    runs.load_by_date(spark, second, house, at(22, 9))
    terms = {r.search_term_id: r.is_active for r in read("search_terms", schemas.CURRENT_SEARCH_TERMS).collect()}
    assert terms == {"t1": False, "t2": True, "t3": False, "t9": True}
    assert read("brand_snapshots", schemas.DATED_BRAND_SNAPSHOTS).count() == 6
    assert read("answer_texts", schemas.DATED_ANSWER_TEXTS).count() == 2
    assert read("citations", schemas.DATED_CITATIONS).count() == 5


def test_streamed_landing_equals_batch(spark, tmp_path, landing):
    from citelight.sources import flatten
    from citelight.streaming.landing import land_new_payloads

    table, bad, progress = (str(tmp_path / n) for n in ("table", "bad", "progress"))
    samples.land(landing, "term_report", "{broken", brand_id="b3")

    def run(hour):
        land_new_payloads(
            spark, f"{landing}/term_report", schemas.TERM_REPORT, flatten.brand_snapshots, table, bad, progress,
            at(22, hour), endpoint="term_report")

    run(6)
    assert spark.read.parquet(table).count() == 6 and spark.read.parquet(bad).count() == 1
    run(7)  # nothing new
    assert spark.read.parquet(table).count() == 6
    samples.land(landing, "term_report", samples.REPORT_B2, brand_id="b4")
    run(8)
    assert spark.read.parquet(table).where("brand_id = 'b4'").count() == 1
    assert spark.read.parquet(table).count() == 7
