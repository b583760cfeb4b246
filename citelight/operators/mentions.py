"""Brand mentions in answer texts: counts, order of first mention, detection metrics.

Spellings may have any number of words. The words of an answer are walked through once: groups of 1, 2 and 4 words are
keyed (a group by the keys of its halves), and a bitmap of the keys that spellings begin with, of fixed size, leaves out nearly
all places. Only what passes becomes a row, with the words that follow there, and meets the spellings in a join by key;
the words themselves decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged


def words_of(text: Column) -> Column:
    """Lower-case words: the text cut at everything that is not a letter, digit or quote mark."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}']+"), "")


#: Bits of the map of wanted keys.
BITS = 1 << 16
#: Sizes of the groups that spellings are looked up by: the largest that a spelling fills.
HEADS = (1, 2, 4)


def _keyed(texts: DataFrame, column: str) -> DataFrame:
    """``texts`` with ``_words`` and a column ``_k<n>`` for each size of a head: the keys of the n words from each word on."""
    keyed = texts.withColumn("_words", words_of(F.col(column)))
    keyed = keyed.withColumn("_k1", F.transform("_words", lambda w: F.xxhash64(w)))
    for size in HEADS[:-1]:
        keys, pairs = F.col(f"_k{size}"), F.greatest(F.size(f"_k{size}") - size, F.lit(0))
        later = F.slice(keys, size + 1, pairs)
        keyed = keyed.withColumn(f"_k{2 * size}", F.zip_with(F.slice(keys, 1, pairs), later, lambda a, b: F.xxhash64(a, b)))
    return keyed


def heads(names: DataFrame) -> DataFrame:
    """Spellings by the group they begin with: brand_name, spelling (its words), size, key.

    The table is written, so that its size is known when a join with it is planned.
    """
    keyed = _keyed(names.select("brand_name", F.col("spelling").alias("_text")), "_text").where("size(_words) > 0")
    n, size, key = F.size("_words"), F.lit(HEADS[0]), F.col("_k1")[0]
    for larger in HEADS[1:]:
        size = F.when(n >= larger, F.lit(larger)).otherwise(size)
        key = F.when(n >= larger, F.get(f"_k{larger}", F.lit(0))).otherwise(key)
    return staged(keyed.select("brand_name", F.col("_words").alias("spelling"), size.alias("size"), key.alias("key")).distinct(), "heads")


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS)).cast("int")


def _wanted(size: int, bits: list[int], ahead: int) -> Column:
    """Size, place, key and following words of the groups of ``size`` words whose bit is set (``bits`` in numbers of 64)."""
    keys, held = F.col(f"_k{size}"), F.lit([w - (1 << 64) if w >> 63 else w for w in bits])
    at = F.when(F.size(keys) > 0, F.sequence(F.lit(0), F.size(keys) - 1)).otherwise(F.array().cast("array<int>"))
    near = F.filter(at, lambda i: F.getbit(held[F.shiftright(_bit(keys[i]), 6)], F.pmod(keys[i], F.lit(64)).cast("int")) == 1)
    return F.transform(near, lambda i: F.struct(
        F.lit(size).alias("size"), i.alias("at"), keys[i].alias("key"), F.slice("_words", i + 1, F.lit(ahead)).alias("ahead")
    ))


def mentions(answers: DataFrame, names: DataFrame, text: str, key: str) -> DataFrame:
    """How often and where first each name occurs in each answer, in words.

    ``names`` has ``brand_name`` and ``spelling`` (one row per spelling; a spelling
    may have several words). Two spellings of a brand that begin at the same word count once. Result: ``key``,
    ``brand_name``, ``mention_count``, ``first_position`` (0 = first word).
    """
    wanted = heads(names)
    longest = {r["size"]: r["n"] for r in wanted.groupBy("size").agg(F.max(F.size("spelling")).alias("n")).collect()}
    bits = {size: [0] * (BITS // 64) for size in longest}
    # At most BITS rows for each size.
    for row in wanted.select("size", _bit(F.col("key")).alias("bit")).distinct().collect():
        bits[row["size"]][row["bit"] // 64] |= 1 << row["bit"] % 64
    near = [_wanted(size, bits[size], longest[size]) for size in sorted(bits)] or [_wanted(1, [0] * (BITS // 64), 1)]
    keyed = _keyed(answers.select(key, F.col(text).alias("_text")), "_text")
    places = keyed.select(key, F.inline(F.concat(*near)))
    same = F.slice("ahead", F.lit(1), F.size("spelling")) == F.col("spelling")
    found = places.join(wanted, ["size", "key"]).where(same)
    return found.groupBy(key, "brand_name").agg(
        F.count_distinct("at").alias("mention_count"), F.min("at").cast("long").alias("first_position")
    )


def mention_rank(found: DataFrame, key: str) -> DataFrame:
    """Add ``position_rank``: 1 for the brand mentioned first in its answer.

    A window partition holds one row per tracked brand.
    """
    window = Window.partitionBy(key).orderBy("first_position")
    return found.withColumn("position_rank", F.rank().over(window).cast("long"))


def detection_metrics(ranked: DataFrame, answers: int) -> DataFrame:
    """Per brand: answers that mention it, detection and top-3 rate in percent, mean rank.

    ``answers`` is the number of answers examined.
    """
    appearances = F.count(F.lit(1))
    top3 = F.count_if(F.col("position_rank") <= 3)
    return ranked.groupBy("brand_name").agg(
        appearances.alias("appearances"),
        (appearances * 100.0 / F.lit(answers)).alias("detection_rate"),
        (top3 * 100.0 / appearances).alias("top3_rate"),
        (F.sum("position_rank") / appearances).alias("avg_rank"),
    )
