"""Landed files are loaded exactly once, and an incremental refresh equals a full one."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import samples
from citelight import schemas
from citelight.plans import runs
from citelight.plans.runs import Warehouse
from citelight.sources import commits, tables

NOW = datetime(2026, 5, 1, tzinfo=timezone.utc)
RUNS = ("2026-04-21", "2026-04-22T06-00-00", "2026-04-23T06-00-00")
RAW = [t for t in schemas.RAW_TABLES if t != "l0_report"]


def newer(report, time):
    """A report with a newer snapshot."""
    terms = [{**t, "lastSnapshotAt": time} for t in report["data"]["searchTerms"]]
    return {"data": {**report["data"], "searchTerms": terms}}


def land_run(root, k):
    run = RUNS[k]
    samples.land(root, "brands", samples.BRANDS, run=run)
    samples.land(root, "search_terms", samples.TERMS_B1, brand_id="b1", run=run)
    samples.land(root, "citations", samples.CITATIONS_B1, brand_id="b1", run=run)
    # The second run repeats the first one's report of b1, which the gate skips, and has a new one of b2.
    b1 = samples.REPORT_B1 if k < 2 else newer(samples.REPORT_B1, "2026-04-29T06:00:00Z")
    samples.land(root, "term_report", b1, brand_id="b1", run=run)
    samples.land(root, "term_report", newer(samples.REPORT_B2, f"2026-04-2{k + 2}T06:00:00Z"), brand_id="b2", run=run)


def content(spark, house, names=RAW):
    return {t: sorted(map(str, house.read(spark, t).collect())) for t in names}


def test_runs_side_by_side_equal_runs_one_by_one(spark, tmp_path):
    apart, together = str(tmp_path / "apart"), str(tmp_path / "together")
    one, all_at_once = Warehouse(str(tmp_path / "one")), Warehouse(str(tmp_path / "all"))
    for k in range(3):
        land_run(apart, k)
        runs.load_raw(spark, apart, one, NOW)
        land_run(together, k)
    runs.load_raw(spark, together, all_at_once, NOW)
    want = content(spark, one)
    assert content(spark, all_at_once) == want
    stamps = one.read(spark, "raw_brands").groupBy(F.to_date(tables.STAMP).cast("string")).count().collect()
    assert sorted(map(tuple, stamps)) == [("2026-04-21", 2), ("2026-04-22", 2), ("2026-04-23", 2)]
    own = one.read(spark, "raw_brand_snapshots").where("brand_id = 'b1'").select(F.to_date(tables.STAMP).alias("d")).distinct()
    assert sorted(str(r.d) for r in own.collect()) == ["2026-04-21", "2026-04-23"]
    # Nothing is new: no commit is made.
    before = commits.newest(spark, f"{one.path('loads')}/_commits")
    runs.load_raw(spark, apart, one, NOW, backfill=True)
    assert commits.newest(spark, f"{one.path('loads')}/_commits") == before and content(spark, one) == want


def test_late_files_and_a_late_run(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), Warehouse(str(tmp_path / "house"))
    land_run(landing, 1)
    runs.load_raw(spark, landing, house, NOW)
    samples.land(landing, "search_terms", samples.TERMS_B2, brand_id="b2", run=RUNS[1])
    land_run(landing, 0)
    runs.load_raw(spark, landing, house, NOW)
    terms = house.read(spark, "raw_search_terms").groupBy("brand_id", F.to_date(tables.STAMP).cast("string").alias("d")).count()
    assert sorted((r.brand_id, r.d) for r in terms.collect()) == [("b1", RUNS[0]), ("b1", "2026-04-22"), ("b2", "2026-04-22")]


def test_a_load_that_fails_midway_is_not_seen(spark, tmp_path, monkeypatch):
    landing, house = str(tmp_path / "landing"), Warehouse(str(tmp_path / "house"))
    land_run(landing, 0)
    runs.load_raw(spark, landing, house, NOW)
    before = content(spark, house)
    land_run(landing, 1)
    broken = lambda payloads: (_ for _ in ()).throw(RuntimeError("lost"))
    monkeypatch.setattr(runs.flatten, "answer_texts", broken)
    with pytest.raises(RuntimeError, match="lost"):
        runs.load_raw(spark, landing, house, NOW)
    monkeypatch.undo()
    assert content(spark, house) == before
    runs.load_raw(spark, landing, house, NOW)
    both = str(tmp_path / "both")
    land_run(both, 0)
    land_run(both, 1)
    clean = Warehouse(str(tmp_path / "clean"))
    runs.load_raw(spark, both, clean, NOW)
    assert content(spark, house) == content(spark, clean)
    # The failed attempt's folders can be swept; what counts stays.
    paths = [house.path(t) for t in RAW]
    assert house.ledger(spark).sweep(paths) > 0 and house.ledger(spark).sweep(paths) == 0
    assert content(spark, house) == content(spark, clean)


def test_whole_documents_and_lines(spark, tmp_path):
    import json

    landing, house = str(tmp_path / "landing"), Warehouse(str(tmp_path / "house"))
    samples.land(landing, "brands", samples.BRANDS, run=RUNS[0])
    folder = os.path.join(landing, "brands", f"run={RUNS[1]}")
    os.makedirs(folder)
    entries = [{"data": {"brands": [{"id": f"x{k}", "name": f"X {k}"}]}} for k in range(50)]
    with open(os.path.join(folder, "many.jsonl"), "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in [*entries])
        out.write("{broken\n")
    with open(os.path.join(folder, "notes.md"), "w") as out:
        out.write("not a payload")
    result = runs.load_raw(spark, landing, house, NOW)
    assert result.failed["brands"] == 1
    assert house.read(spark, "raw_brands").count() == 52
    assert house.ledger(spark).files().count() == 2


def file_times(spark, house, fact):
    """Modification times of the files of every week."""
    root = tables.table_path(spark, house.path(fact))
    return {
        week: sorted((name, os.stat(os.path.join(root, week, name)).st_mtime_ns) for name in os.listdir(os.path.join(root, week)))
        for week in os.listdir(root) if week.startswith("snapshot_week=")
    }


@pytest.mark.parametrize("seed", range(2))
def test_random_changes_refresh_exactly(spark, tmp_path, seed):
    rng = random.Random(seed)
    house = Warehouse(str(tmp_path / "house"))
    runs.create_tables(spark, house)
    clock = lambda: None if rng.random() < 0.15 else datetime(2026, 1, 5, 6) + timedelta(days=rng.randrange(60))

    def batch(stamp, ids):
        answers = [("b1", f"t{i % 3}", f"x{i}" if i else None, clock(), "engine", f"text {stamp} {i}", stamp) for i in ids]
        snaps = [("b1", f"t{rng.randrange(3)}", "", "p", "P", clock(), f"brand {i % 4}", False, float(i), stamp) for i in ids]
        ledger, raw = house.ledger(spark), schemas.RAW_TABLES
        snap_names = [
            "brand_id", "search_term_id", "engine", "topic_id", "topic_name", "last_snapshot_at", "brand_name", "is_own_brand",
            "visibility_score", tables.STAMP,
        ]
        of = {f.name: f for f in raw["raw_brand_snapshots"].fields}
        rows = spark.createDataFrame(snaps, runs.StructType([of[c] for c in snap_names]))
        ledger.append({
            house.path("raw_answer_texts"): spark.createDataFrame(answers, raw["raw_answer_texts"]),
            house.path("raw_brand_snapshots"): rows.select(
                *[F.col(c) if c in snap_names else F.lit(None).cast(f.dataType).alias(c) for c, f in of.items()]),
        })

    start = datetime(2026, 3, 10, 6)
    batch(start, range(40))
    runs.incremental_refresh(spark, house)
    facts = ("l1_fact_snapshots", "l1_fact_citations", "l1_fact_answer_texts")
    for turn in range(2):
        # Now and then a run is loaded after a later one, and ids share one stamp with stored ones.
        stamp = start + timedelta(days=rng.choice([-2, 0, turn + 1]))
        batch(stamp, rng.sample(range(60), 6))
        before = {f: file_times(spark, house, f) for f in facts}
        weeks_of = lambda: {
            tuple(r) for r in house.read(spark, "l1_fact_answer_texts").select("snapshot_week", "execution_id", "answer_text").collect()}
        rows_before = weeks_of()
        runs.incremental_refresh(spark, house)
        changed = {w for w, *_ in rows_before ^ weeks_of()}
        after = file_times(spark, house, "l1_fact_answer_texts")
        kept = {w for w in before["l1_fact_answer_texts"] if before["l1_fact_answer_texts"][w] == after.get(w)}
        assert kept and not {f"snapshot_week={w}" for w in changed if w} & kept
        fast = content(spark, house, facts)
        want = {
            "l1_fact_snapshots": runs.layers.fact_snapshots(house.read(spark, "raw_brand_snapshots")),
            "l1_fact_citations": runs.layers.fact_citations(house.read(spark, "raw_citations")),
            "l1_fact_answer_texts": runs.layers.fact_answer_texts(house.read(spark, "raw_answer_texts")),
        }
        for fact, df in want.items():
            assert fast[fact] == sorted(map(str, df.select(*house.read(spark, fact).columns).collect())), fact
