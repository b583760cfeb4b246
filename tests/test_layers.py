from datetime import date

from pyspark.sql import functions as F

from citelight.operators import tags
from citelight.plans import layers, quality

SNAP = (
    "brand_id string, search_term_id string, engine string, topic_id string, topic_name string,"
    " last_snapshot_at string, brand_name string, is_own_brand boolean, visibility_score double,"
    " etl_loaded_at string"
)


def snapshots(spark, rows):
    df = spark.createDataFrame(rows, SNAP).withColumns({
        "last_snapshot_at": F.to_timestamp("last_snapshot_at"), "etl_loaded_at": F.to_timestamp("etl_loaded_at"),
    })
    extra = {"avg_sentiment": "double", "avg_rank": "double", "latest_rank": "bigint", "detection_rate": "double",
             "top3_rate": "double", "citation_count": "bigint", "appearances": "bigint"}
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in extra.items()})


def snap(term, brand, at, loaded, value, own=False, owner="b1"):
    return (owner, term, "e", "p", "P", at, brand, own, value, loaded)


def test_snapshot_grain(spark):
    rows = [
        snap("t1", "A", "2026-04-21 06:00:00", "2026-04-21 08:00:00", 10.0),
        snap("t1", "A", "2026-04-23 06:00:00", "2026-04-23 08:00:00", 20.0),  # same week, later: kept
        snap("t1", "A", "2026-04-23 06:00:00", "2026-04-24 08:00:00", 25.0),  # same snapshot loaded later: kept
        snap("t1", "A", None, "2026-04-25 08:00:00", 99.0),  # no snapshot time: last
        snap("t1", "A", "2026-04-28 06:00:00", "2026-04-28 08:00:00", 30.0),  # next week
        snap("t1", "B", None, "2026-04-22 08:00:00", 75.0),  # dated by its load
        snap("t2", "A", "2026-04-21 06:00:00", "2026-04-21 08:00:00", 0.0),
    ]
    facts = layers.fact_snapshots(snapshots(spark, rows)).collect()
    got = {(r.search_term_id, r.brand_name, r.snapshot_week): r for r in facts}
    assert len(facts) == len(got) == 4
    first = got[("t1", "A", "2026-17")]
    assert (first.visibility_score, first.snapshot_date, first.ai_share_of_voice) == (25.0, date(2026, 4, 23), 0.25)
    assert got[("t1", "B", "2026-17")].snapshot_date == date(2026, 4, 22)
    assert got[("t1", "A", "2026-18")].ai_share_of_voice == 1.0
    assert got[("t2", "A", "2026-17")].ai_share_of_voice is None


def test_name_as_own_brand_and_competitor(spark):
    """The key has no owner, so one row survives: the own-brand row when the times tie."""
    same = ("2026-04-21 06:00:00", "2026-04-21 08:00:00")
    rows = [snap("t1", "A", *same, 50.0, own=False), snap("t1", "A", *same, 10.0, own=True, owner="b2")]
    facts = layers.fact_snapshots(snapshots(spark, rows)).collect()
    assert [(r.is_own_brand, r.brand_id, r.visibility_score) for r in facts] == [(True, "b2", 10.0)]


def test_loading_again_changes_nothing(spark):
    raw = snapshots(spark, [
        snap(f"t{i % 5}", f"B{i % 3}", f"2026-04-{10 + i % 9} 06:00:00", f"2026-04-{20 + i % 3} 06:00:00", float(i))
        for i in range(60)
    ])
    once, twice = (sorted(map(tuple, layers.fact_snapshots(df).collect()), key=str) for df in (raw, raw.union(raw)))
    assert once == twice
    facts = layers.fact_snapshots(raw)
    assert quality.repeated_keys(facts, ["search_term_id", "brand_name", "snapshot_week"]).isEmpty()


def test_deduplication_runs_once_for_rows_and_sums(spark, tmp_path):
    path = str(tmp_path / "raw")
    snapshots(spark, [snap("t1", "A", "2026-04-21 06:00:00", "2026-04-21 08:00:00", 1.0)]).write.parquet(path)
    facts = layers.fact_snapshots(spark.read.parquet(path))
    facts.collect()
    final = facts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_brand_activity(spark):
    raw = spark.createDataFrame([
        ("b1", "Old name", "d", True, "2026-04-20 06:00:00"), ("b1", "One", "d", True, "2026-04-21 06:00:00"),
        ("b2", "Two", None, True, "2026-04-20 06:00:00"), ("b3", "Three", None, True, "2026-04-21 01:00:00"),
    ], "brand_id string, name string, domain string, is_own_brand boolean, etl_loaded_at string").withColumn(
        "etl_loaded_at", F.to_timestamp("etl_loaded_at"))
    got = {r.brand_id: (r.name, r.is_active) for r in layers.dim_brands(raw).collect()}
    assert got == {"b1": ("One", True), "b2": ("Two", False), "b3": ("Three", True)}


def test_citation_key_ignores_missing_urls(spark):
    raw = spark.createDataFrame([
        ("b", "t", "e", "d", None, 1, "2026-04-21 06:00:00"), ("b", "t", "e", "d", "", 2, "2026-04-22 06:00:00"),
        ("b", None, "e", "d", "u", 3, "2026-04-21 06:00:00"), ("b", None, "e", "d", "u", 4, "2026-04-22 06:00:00"),
        ("b", "t", "e", "d", "u", 5, "2026-04-21 06:00:00"), ("b", "t", "e", "d", "u", 6, "2026-04-28 06:00:00"),
    ], "brand_id string, search_term_id string, engine string, domain string, url string, occurrences bigint,"
       " etl_loaded_at string").withColumn("etl_loaded_at", F.to_timestamp("etl_loaded_at"))
    assert sorted(r.occurrences for r in layers.fact_citations(raw).collect()) == [2, 4, 5, 6]


TERMS = "search_term_id string, brand_id string, topic_id string, topic_name string, engine string, query string, tags string"


def terms(spark):
    texts = ['["north", " top funnel "]', '["dup","dup"]', "[]", "null", "", None, "[broken", '{"a":1}']
    return spark.createDataFrame([(f"t{i}", "b", None if i == 1 else "p", "P", "e", "q", x) for i, x in enumerate(texts)], TERMS)


def test_tag_bridge_and_filters(spark):
    df = terms(spark)
    bridge = layers.l2_search_term_tags(df)
    assert sorted((r.search_term_id, r.tag) for r in bridge.collect()) == [
        ("t0", "north"), ("t0", "top funnel"), ("t1", "dup"), ("t1", "dup")]
    facts = spark.createDataFrame([("t0",), ("t1",), ("t1",), ("t9",), (None,)], "search_term_id string")
    assert tags.with_tag(facts, bridge, "dup").count() == 2  # a repeated tag multiplies nothing
    assert tags.blend_tags(facts, bridge).count() == 2 + 4 + 1 + 1
    ids = lambda cond: sorted(r.search_term_id for r in df.where(cond).collect())
    assert ids(tags.has_tag(F.col("tags"), "dup")) == ["t1"]
    assert ids(tags.matches_tags(F.col("tags"), ["dup", "north"])) == ["t0", "t1"]
    assert ids(tags.matches_tags(F.col("tags"), [tags.UNTAGGED])) == ["t2", "t3", "t4", "t5", "t6", "t7"]
    assert ids(tags.matches_tags(F.col("tags"), ["dup", tags.UNTAGGED]) & tags.matches_topic(F.col("topic_id"), tags.ORPHANED)) == ["t1"]


def test_facts_without_dimension_stay(spark):
    facts = layers.fact_snapshots(snapshots(spark, [
        snap("t0", "A", "2026-04-21 06:00:00", "2026-04-21 08:00:00", 1.0),
        snap("gone", "A", "2026-04-21 06:00:00", "2026-04-21 08:00:00", 1.0),
    ]))
    dim = terms(spark).withColumns({
        "region": F.lit("cz"), "interval": F.lit("weekly"), "is_active": F.lit(True),
        "last_execution_time": F.lit(None).cast("timestamp"), "next_execution_time": F.lit(None).cast("timestamp"),
    })
    got = {r.search_term_id: (r.query, r.owning_brand_id) for r in layers.l2_snapshots(facts, dim).collect()}
    assert got == {"t0": ("q", "b"), "gone": (None, None)}


def test_slicer(spark):
    df = spark.createDataFrame([
        ("p1", "e1", '["a"]', "Me", True, "q1"), ("p1", "e2", "[]", "X", False, "q1"),
        ("p2", "e1", '["b"]', "Y", False, "q2"), (None, "e1", None, "X", False, "q3"),
    ], "topic_id string, engine string, tags string, brand_name string, is_own_brand boolean, query string")
    assert tags.slice_rows(df).count() == 4
    assert tags.slice_rows(df, topic="p1", competitors="X").count() == 2
    assert tags.slice_rows(df, engine=["e1"], tags=["a", "b"]).count() == 2
    assert tags.slice_rows(df, topic=tags.ORPHANED, tags=tags.UNTAGGED, prompt="q3").count() == 1


def test_quality(spark):
    df = spark.createDataFrame([("b1", "x")] * 3 + [("b2", None)], "brand_id string, v string")
    assert [(r.brand_id, r.rows) for r in quality.capped_pages(df, cap=3).collect()] == [("b1", 3)]
    assert quality.missing_values(df, ["brand_id", "v"]).first().asDict() == {"brand_id": 0, "v": 1}
    assert quality.repeated_keys(df, ["brand_id"]).count() == 1
