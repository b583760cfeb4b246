"""Extra columns with any names, rows that share an id or lack one, and what worker processes keep."""

import time

import pytest
from pyspark.sql import functions as F

from citelight.llm import decontamination, language, lines, minhash, mixing, quality, spans, tokens
from citelight.session import staged

#: Names that operators use inside, and some that are awkward by themselves.
NAMES = [
    "epochs", "cut_key", "cut_words", "_r_source", "_size", "_key", "Size", "_row", "row", "_time", "_before", "__before", "_piece",
    "_chance", "covered", "_id", "_hash", "_firsts", "removed_", "_lettered", "key", "range", "weight", "a.b", "tick`ed",
]


@pytest.fixture(scope="module")
def plain(spark):
    texts = [f"the {w} walks over a {w} hill and sees {n} birds there\nand a line" for n, w in enumerate("red blue green wide".split() * 5)]
    rows = [(n, t, ["en", "de"][n % 2], ["a", "b", None][n % 3], len(t)) for n, t in enumerate(texts)]
    return staged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "docs")


@pytest.fixture(scope="module")
def crowded(plain):
    return plain.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in NAMES])


def carried(found, names=NAMES):
    """Every row still has its own value in every extra column."""
    rows = found.select("doc_id", *[F.col(tokens.quoted(name)) for name in names]).collect()
    assert rows and all(row[name] == f"{name} {row['doc_id']}" for row in rows for name in names)
    return found


def same(found, expected):
    names = expected.columns
    order = lambda df: sorted(map(str, df.select(*[F.col(tokens.quoted(c)) for c in names]).collect()))
    assert order(found) == order(expected)


def test_mixing(plain, crowded):
    names = [n for n in NAMES if n != "Size"]  # named like an output column, so replaced
    found = carried(mixing.mix(crowded), names)
    same(found, mixing.mix(plain))
    same(carried(mixing.materialise(found), names), mixing.materialise(mixing.mix(plain)))


def test_quality(plain, crowded):
    target = plain.where("doc_id < 5")
    same(carried(quality.resample(crowded, target, 0.5)), quality.resample(plain, target, 0.5))
    same(carried(quality.scores(crowded, target)), quality.scores(plain, target))


def test_spans_and_lines(plain, crowded):
    same(carried(spans.drop_repeats(crowded)), spans.drop_repeats(plain))
    same(carried(lines.apply(crowded, lines.duplicate_lines(crowded))), lines.apply(plain, lines.duplicate_lines(plain)))


def test_language_and_decontamination(spark, plain, crowded):
    model = language.train(plain)
    same(carried(language.predict(model, crowded)), language.predict(model, plain))
    bench = spark.createDataFrame([("i1", "over a red hill")], "item_id string, text string")
    same(carried(decontamination.scan(crowded, bench)), decontamination.scan(plain, bench))


def test_rows_that_share_an_id_or_lack_one(spark):
    """Thousands of different texts under one id or none take time in proportion, and each is compared as itself."""
    own = F.concat_ws(" ", *[F.md5(F.concat("id", F.lit(str(k)))) for k in range(8)])
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"),
        # Every 100th row is a near copy of the row before: one of eight words differs, no shingle of 5 at its end.
        F.concat(F.expr("repeat('x y z ', 4)"), own).alias("text"), "id",
    )
    near = rows.where("id % 100 = 0").withColumn("text", F.concat("text", F.lit(" tail")))
    docs = staged(rows.unionByName(near).select("doc_id", "text"), "docs")
    began = time.monotonic()
    found = minhash.near_duplicates(docs, width=5, percent=80).collect()
    assert time.monotonic() - began < 60
    assert len(found) == 4_040
    groups = {}
    for row in found:
        groups.setdefault(row["component"], set()).add(row["text_hash"])
    assert sorted(len(g) for g in groups.values()) == [1] * 3_960 + [2] * 40
    assert {row["component_id"] for row in found} == {7, None}


def test_workers_keep_for_one_owner():
    tokens._KEPT.clear()
    made = []
    make = lambda: made.append(1) or len(made)
    assert tokens.keep("a", make) == tokens.keep("a", make) == 1
    tokens.let_go("a")
    assert tokens.keep("a", make) == 1
    tokens.let_go()
    assert tokens.keep("a", make) == 2
    tokens.let_go("b")
    assert not tokens._KEPT


def test_long_texts_leave_no_tables_behind():
    tokens._powers(4 * tokens.SLICE_BYTES)
    tokens.give_back()
    assert not tokens._POWERS
    tokens._powers(10)
    tokens.give_back()
    assert len(tokens._POWERS[0]) == tokens.SLICE_BYTES + (1 << 16)
    tokens._POWERS.clear()
