from pyspark.sql import functions as F

from citelight.functions import ascii_key
from citelight.operators.lookup import BRAND_SPELLINGS, LENIENT, brand_ids, canonical_name, normalise_names, with_dimension


def test_names_and_ids(spark):
    seen = spark.createDataFrame(
        [("KB",), ("Komerční banka",), ("Ceska sporitelna",), ("Nobody",), (None,)], "brand_name string")
    spellings = spark.createDataFrame(list(BRAND_SPELLINGS.items()), "variant string, canonical string")
    brands = spark.createDataFrame(
        [("b2", "Komerční banka"), ("b1", "Komerční banka"), ("b3", "Česká spořitelna")], "brand_id string, name string")
    named = normalise_names(seen, "brand_name", spellings, "variant", "canonical", "canonical_name")
    assert named.select("canonical_name").collect() == seen.select(
        canonical_name(F.col("brand_name")).alias("canonical_name")).collect()
    got = {r.brand_name: r.brand_id for r in brand_ids(named, "canonical_name", brands).collect()}
    assert got == {"KB": "b1", "Komerční banka": "b1", "Ceska sporitelna": None, "Nobody": None, None: None}
    # Accent-free names match when both sides use the accent-free key.
    plain = brands.withColumn("name", ascii_key(F.col("name")))
    got = {r.brand_name: r.brand_id for r in
           brand_ids(named, "canonical_name", plain, key=ascii_key(F.col("canonical_name"))).collect()}
    assert got["Ceska sporitelna"] == "b3" and got["KB"] == "b1" and got["Nobody"] is None


def test_names_alike_under_a_collation(spark):
    pairs = [
        ("Česká spořitelna", "CESKA SPORITELNA"), ("Česká spořitelna", "Ceska\u0301 sporitelna"), ("Straße", "STRASSE"),
        ("Καφές", "καφες"), ("Ёлка", "елка"), ("Société", "Socie\u0301te\u0301"), ("北京", "北京"),
    ]
    brands = spark.createDataFrame(
        [(f"b{i}", name) for i, name in enumerate(dict.fromkeys(n for n, _ in pairs))] + [("a9", "SOCIETE")],
        "brand_id string, name string")
    ids = {n: f"b{i}" for i, n in enumerate(dict.fromkeys(n for n, _ in pairs))} | {"Société": "a9"}
    seen = spark.createDataFrame([(s,) for _, s in pairs] + [("Ceska",), ("北",), ("",), (None,)], "brand_name string")
    got = {r.brand_name: r.brand_id for r in brand_ids(seen, "brand_name", brands, collation=LENIENT).collect()}
    assert got == {s: ids[n] for n, s in pairs} | {"Ceska": None, "北": None, "": None, None: None}
    strict = {r.brand_name: r.brand_id for r in brand_ids(seen, "brand_name", brands).collect()}
    assert [s for s, b in strict.items() if b] == ["北京"]


def test_dimension_join_keeps_every_fact(spark):
    facts = spark.createDataFrame([("t1", 1), ("t2", 2), (None, 3)], "term string, v int")
    dim = spark.createDataFrame([("t1", "one"), (None, "never")], "term string, label string")
    got = {(r.v, r.label) for r in with_dimension(facts, dim, "term", ["label"]).collect()}
    assert got == {(1, "one"), (2, None), (3, None)}


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, plan_of, tmp_path):
    facts, dim = str(tmp_path / "facts"), str(tmp_path / "dim")
    spark.range(1000).select(F.col("id").alias("term"), F.col("id").alias("v")).write.parquet(facts)
    spark.range(1000).select(F.col("id").alias("term"), F.sha2(F.col("id").cast("string"), 256).alias("label")).write.parquet(dim)
    build = lambda: with_dimension(spark.read.parquet(facts), spark.read.parquet(dim), "term", ["label"])
    assert "BroadcastHashJoin" in plan_of(build())
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        assert "SortMergeJoin" in plan_of(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
