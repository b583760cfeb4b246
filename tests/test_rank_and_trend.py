import random

from pyspark.sql import Window, functions as F

from citelight.operators.rank import rank_in_group
from citelight.operators.trend import change_from_previous, moving_average, weekly_values


def ranked(df):
    return sorted(((r.g, r.v, r.id), r.rank) for r in df.collect() if r.v is not None and r.g is not None)


def test_split_rank_equals_window_rank(spark):
    """A hot group, heavy ties, NULL groups and NULL values; several pieces per group."""
    random.seed(11)
    rows = [
        (i, random.choice(["hot"] * 6 + ["a", "b", None]), random.choice([None, 5.0, 5.0] + [random.randint(0, 400) / 4] * 3))
        for i in range(4000)
    ]
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(5)
    by_window = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    split, window = rank_in_group(df, ["g"], "v"), df.withColumn("rank", F.rank().over(by_window).cast("long"))
    assert ranked(split) == ranked(window)
    nulls = lambda d: sorted((str(r.g), str(r.v), r.id, r.rank) for r in d.collect() if r.v is None or r.g is None)
    assert nulls(split) == nulls(window)
    assert split.count() == 4000


def test_moving_average(spark):
    rows = [("a", d, float(d)) for d in range(1, 11)] + [("b", 1, None), ("b", 2, 4.0)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    got = {(r.k, r.d): r.v_ma for r in moving_average(df, ["k"], "d", "v", 7).collect()}
    assert got[("a", 1)] == 1.0 and got[("a", 3)] == 2.0 and got[("a", 10)] == 7.0
    assert got[("b", 1)] is None and got[("b", 2)] == 4.0


def test_change_from_previous(spark):
    df = spark.createDataFrame(
        [("t", "2026-01", 10.0, 3.0), ("t", "2026-02", 12.0, 2.0), ("t", "2026-03", 12.0, 4.0), ("u", "2026-02", 1.0, 1.0)],
        "t string, w string, v double, r double")
    got = {(x.t, x.w): (x.v_change, x.v_direction, x.r_direction) for x in
           change_from_previous(df, ["t"], "w", {"v": True, "r": False}).collect()}
    assert got == {("t", "2026-01"): (None, None, None), ("t", "2026-02"): (2.0, "up", "improved"),
                   ("t", "2026-03"): (0.0, None, "declined"), ("u", "2026-02"): (None, None, None)}


def test_weekly_values(spark):
    df = spark.createDataFrame([("t", "w", 1.0), ("t", "w", 2.0)], "t string, w string, v double")
    assert weekly_values(df, ["t"], "w", ["v"]).first().v == 1.5
