import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from citelight.operators.latest import last_in_batch, latest_per_key, top_per_group
from citelight.operators.share import share_of_voice


def make(spark, rows, schema, parts=6):
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_latest_against_brute_force(spark):
    """One key owns a third of the rows, another is NULL; order values tie and are missing."""
    random.seed(7)
    rows = [
        (random.choice(["hot"] * 10 + [None] + list("abcdefghij") * 2), random.choice([None, 1, 2, 3]),
         random.randint(0, 4), random.choice(["x", "y", None]))
        for _ in range(3000)
    ]
    df = make(spark, rows, "k string, at int, load int, payload string")
    got = {r.k: tuple(r) for r in latest_per_key(
        df, ["k"], [F.desc_nulls_last("at"), F.desc_nulls_last("load")]).collect()}
    high = lambda v: (v is not None, v if v is not None else 0)
    text = lambda v: (v is not None, v or "")
    want = {
        k: max((r for r in rows if r[0] == k), key=lambda r: (high(r[1]), high(r[2]), text(r[3])))
        for k in {r[0] for r in rows}
    }
    assert got == want


def test_ties_are_settled_the_same_way_every_time(spark):
    rows = [("a", 1, str(i)) for i in range(100)]
    picks = set()
    for parts in (1, 3, 7):
        random.shuffle(rows)
        df = make(spark, rows, "k string, at int, payload string", parts)
        picks.add(tuple(latest_per_key(df, ["k"], [F.desc("at")]).first()))
    assert picks == {("a", 1, "99")}


def test_columns_without_order_are_carried(spark):
    df = spark.sql("SELECT 'a' AS k, 1 AS at, map('x', 1) AS m, named_struct('y', array(1)) AS s")
    assert latest_per_key(df, ["k"], [F.desc("at")]).first().m == {"x": 1}


def test_last_in_batch(spark):
    df = make(spark, [("a", 1, "old"), ("a", 2, "new"), ("b", 0, "only")], "k string, seq int, v string")
    assert {r.k: r.v for r in last_in_batch(df, "k", "seq").collect()} == {"a": "new", "b": "only"}


def test_top_per_group(spark):
    rows = [("hot", i, i % 7) for i in range(500)] + [("b", i, i) for i in range(2)]
    got = top_per_group(make(spark, rows, "g string, id int, v int"), ["g"], [F.desc("v"), F.asc("id")], 3).collect()
    assert sorted((r.g, r.position, r.id) for r in got) == [
        ("b", 1, 1), ("b", 2, 0), ("hot", 1, 6), ("hot", 2, 13), ("hot", 3, 20)]


@pytest.mark.parametrize("build", [
    lambda df: latest_per_key(df, ["k"], [F.desc("at")]),
    lambda df: top_per_group(df, ["k"], [F.desc("at"), F.asc("payload")], 10),
])
def test_rows_are_cut_before_the_shuffle(spark, plan_of, build):
    df = spark.range(100).repartition(3).select(
        F.col("id").alias("k"), F.col("id").alias("at"), F.col("id").alias("payload"))
    plan = plan_of(build(df))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_share_of_voice(spark):
    rows = [
        ("t1", "w1", 30.0), ("t1", "w1", 60.0), ("t1", "w1", 10.0), ("t1", "w1", None),
        ("t1", "w2", 5.0), ("zero", "w1", 0.0), ("zero", "w1", 0.0), ("none", "w1", None), (None, "w1", 4.0),
        (None, "w1", 12.0),
    ]
    got = share_of_voice(make(spark, rows, "t string, w string, v double"), "v", ["t", "w"]).collect()
    shares = sorted(((r.t or "-", r.w, r.v), r.ai_share_of_voice) for r in got if r.v is not None)
    assert shares == [
        (("-", "w1", 4.0), 0.25), (("-", "w1", 12.0), 0.75), (("t1", "w1", 10.0), 0.1), (("t1", "w1", 30.0), 0.3),
        (("t1", "w1", 60.0), 0.6), (("t1", "w2", 5.0), 1.0), (("zero", "w1", 0.0), None), (("zero", "w1", 0.0), None),
    ]
    assert [r.ai_share_of_voice for r in got if r.v is None] == [None, None]
    assert len(got) == len(rows)


def test_hot_groups_give_the_same_shares(spark):
    random.seed(9)
    rows = [(random.choice(["hot"] * 3 + [None] * 2 + list("abcde")), i, random.randint(0, 50) / 10) for i in range(3000)]
    df = make(spark, rows, "t string, id int, v double")
    # The join of the sums once broadcast and once shuffled, with and without parts of the hot group split off.
    shares = []
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        shares.append(sorted((r.id, r.s) for r in share_of_voice(df, "v", ["t"], "s").collect()))
    for name in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)
    sums = {t: sum(Decimal(str(v)) for u, _, v in rows if u == t) for t in {t for t, _, _ in rows}}
    assert shares[0] == shares[1] == sorted((i, v / float(sums[t])) for t, i, v in rows)


def test_shares_of_a_group_add_up_to_one(spark):
    random.seed(3)
    rows = [(random.choice(["hot"] * 5 + list("abcde")), random.randint(0, 1000) / 10) for _ in range(2000)]
    shared = share_of_voice(make(spark, rows, "t string, v double"), "v", ["t"])
    for r in shared.groupBy("t").agg(F.sum("ai_share_of_voice").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_share_has_no_window_over_the_group(spark, plan_of):
    df = spark.range(10).select((F.col("id") % 2).alias("t"), F.col("id").cast("double").alias("v"))
    plan = plan_of(share_of_voice(df, "v", ["t"]))
    assert "Window" not in plan and "partial_sum" in plan
