"""Mixing sources to target weights with DataFrame functions only.

Every document gets a hash-random key. The keys of a source are cut into ranges of about
``RANGE_ROWS`` documents; token counts are summed per range, prefix sums over the ranges
say in which one the source's budget ends, and only that range is sorted and summed
document by document. The key where the budget ends is one small row per source, so
the documents themselves are never sorted or shuffled: each compares its key with it.

Rows: a null or empty text has size 0. Documents without source form one source, ordered
last. Rows that repeat id and text share a key; where the budget ends among them, each
takes an equal share of what is left. Sources without words have target 0. Input columns
named like an output column (in any case) are replaced; all others are carried along whatever their names. An empty table
gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.share import join_null_safe
from ..session import staged
from .prefix import running_totals
from .tokens import folded, quoted, unused

RANGE_ROWS = 1_000
WORD = r"[^\x20\x09-\x0D]+"
PLAN_COLUMNS = ("size", "source_size", "target", "taken", "repeats")


def size() -> Column:
    """Words of the text; 0 for a null text."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: str) -> Column:
    """A key that depends on the document alone, so reruns and lost tasks give the same order."""
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), text).cast("binary"))


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``target`` words of every source (columns source, source_size, rows).

    ``weights`` go round over the sources by code point, null last. The sources share ``share``
    times all words by weight; a target above ``most`` times its source stops there and the
    others share the excess, until none is above.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = running_totals(sources, order, {"_position": F.lit(1)})
    turn = F.col("_position") % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long")
    ranked = ranked.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * most)
    ranked = running_totals(
        ranked, [F.col("_cap") / F.col("weight"), *order], {"_caps": F.col("_cap"), "_weights": F.col("weight")}
    )
    words, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = float(share * (words or 0))
    # In order of cap by weight, a source is full when the level that the fuller ones leave exceeds it.
    full = (F.lit(budget) - F.col("_caps")) * F.col("weight") >= F.col("_cap") * (F.lit(all_weights or 0) - F.col("_weights"))
    ranked = staged(ranked.withColumn("_full", full), "targets")
    held, held_weights = ranked.where("_full").agg(F.sum("_cap"), F.sum("weight")).first()
    free, free_weight = budget - (held or 0), (all_weights or 0) - (held_weights or 0)
    shared = F.lit(free) * F.col("weight") / F.lit(max(free_weight, 1))
    return ranked.select(
        "source", "source_size", "rows", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(shared).alias("target")
    )


def cuts(
    docs: DataFrame, weights: Sequence[int], share: float, most: int, seed: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Per source: size, target, whole epochs, and the key at which the last epoch's budget ends.

    ``cut_words`` is what each row with the cut key still takes.
    """
    keyed = staged(docs.select("source", size().alias("size"), random_key(seed).alias("key")), "keyed")
    sources = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    plan = targets(sources, weights, share, most)
    epochs = F.coalesce(F.floor(F.expr("target / nullif(source_size, 0)")), F.lit(0)).cast("long")
    plan = plan.withColumn("epochs", epochs).withColumn(
        "_rest", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size")
    )
    plan = staged(plan, "plan")
    # Keys are uniform, so equal ranges of the key hold about equally many documents of a source.
    place = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    ranges = F.floor(place * F.ceil(F.col("rows") / range_rows)).cast("long")
    ranged = join_null_safe(keyed, plan.select("source", "rows", "_rest"), ["source"], "inner").select(
        "source", "_rest", ranges.alias("range"), "key", "size"
    )
    sums = ranged.groupBy("source", "_rest", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    last = staged(sums.where("before <= _rest AND _rest < before + words").select("source", "range", "before"), "last")
    tied = (
        join_null_safe(ranged, last, ["source", "range"], "inner")
        .groupBy("source", "_rest", "before", "key", "size").agg(F.count("*").alias("n"))
    )
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    tied = tied.withColumn("before", F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(inside), F.lit(0)))
    cut = tied.where("before <= _rest AND _rest < before + n * size").select(
        "source", F.col("key").alias("cut_key"), F.expr("(_rest - before) div n").alias("cut_words")
    )
    return staged(join_null_safe(plan.drop("_rest", "rows"), cut, ["source"], "left"), "cuts")


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix"
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target, taken, repeats.

    ``taken`` counts words over all epochs and meets the target to the word. ``repeats`` is how
    often the whole document is taken; the one at the cut is whole if at least half of it is in.
    """
    plan = cuts(docs, weights, share, most, seed)
    names = [c for c in docs.columns if c.lower() not in PLAN_COLUMNS]
    keyed = docs.select("source", folded(names), size().alias("_size"), random_key(seed).alias("_key"))
    rows = join_null_safe(keyed, plan, ["source"], "inner")
    under = F.coalesce(F.col("_key") < F.col("cut_key"), F.lit(False))
    at = F.coalesce(F.col("_key") == F.col("cut_key"), F.lit(False))
    part = F.when(under, F.col("_size")).when(at, F.least("_size", "cut_words")).otherwise(F.lit(0))
    whole = under | (at & (F.col("cut_words") * 2 >= F.col("_size")))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in names], F.col("_size").alias("size"), "source_size",
        "target", (F.col("epochs") * F.col("_size") + part).cast("long").alias("taken"),
        (F.col("epochs") + whole.cast("long")).alias("repeats"),
    )


def materialise(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document as many times as it is taken whole."""
    times = F.array_repeat(F.lit(1), F.col("repeats").cast("int"))
    names = [c for c in mixed.columns if c not in PLAN_COLUMNS]
    time = unused(names, "_time")
    return mixed.select(*[F.col(quoted(c)) for c in names], F.explode(times).alias(time)).drop(time)
