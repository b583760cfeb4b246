"""Importance resampling: documents that read like a target, by hashed n-gram models.

Two generative models over hashed word n-grams are counted, one over at most ``TARGET_ROWS``
target texts, one over all texts. A document's log weight is the mean log ratio of its n-grams, scaled to ``SCALE``
n-grams so that long texts have no advantage; few n-grams are drawn towards 0. A Gumbel
variable, a function of the document, is added, and the documents with the largest sums are
a sample without replacement in proportion to the weights. The cut is exact: ranks are prefix
counts over range partitions.

Rows: a null or empty text has no n-grams and weight 0. Rows that repeat have the same sum and are
ranked next to each other, rows without id last. With an empty target all ratios are those of smoothing.
Input columns named like an output column (in any case) are replaced, all others are carried along whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .prefix import running_totals
from .tokens import WORDS_AND_MARKS, bounded, folded, mix, seeds, slices, token_hashes, unfolded

SLOTS = 1 << 18
#: Labelled documents that the target model is learned from at most; their ids fit into any task.
TARGET_ROWS = 20_000
SCALE = 500.0
#: n-grams of ratio 1 that every document is taken to have besides its own.
PRIOR = 20.0
OUTPUT = ("n_grams", "log_weight", "sample_key", "kept")


def _grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all words and pairs of words, each one's row, and the number of each row."""
    hashes, _, _, first = token_hashes(text, WORDS_AND_MARKS)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    factors = seeds(3, 2)
    pairs = mix(hashes[:-1] * factors[0] + hashes[1:] * factors[1])[owner[1:] == owner[:-1]]
    row = np.r_[owner, owner[1:][owner[1:] == owner[:-1]]]
    slot = (np.r_[hashes, pairs] >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
    return slot, row, np.bincount(row, minlength=len(sizes))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            slot, _, _ = _grams(part.column("text"))
            total += np.bincount(slot, minlength=SLOTS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["slot", "n"])


def target_rows(docs: DataFrame, good: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """The documents named in ``good`` (doc_id), at most ``rows`` ids of them, those with the smallest hash."""
    ids = good.where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.join(F.broadcast(ids), "doc_id", "left_semi")


def gram_counts(texts: DataFrame) -> np.ndarray:
    """How often each of the ``SLOTS`` hashed n-grams occurs; tasks send one sum per slot."""
    rows = bounded(texts.select(F.col("text").cast("string").alias("text"))).mapInArrow(_count, "slot long, n long")
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def log_ratios(target: np.ndarray, everything: np.ndarray) -> np.ndarray:
    """Log of target probability over general probability, both smoothed by one count per slot."""
    return np.log((target + 1) / (target.sum() + SLOTS)) - np.log((everything + 1) / (everything.sum() + SLOTS))


def _scorer(ratios: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                slot, row, grams = _grams(part.column("text"))
                total = np.bincount(row, weights=ratios[slot], minlength=part.num_rows)
                weight = SCALE * total / (grams + PRIOR)
                chance = part.column("_chance").to_numpy().view(np.uint64)
                uniform = ((mix(chance) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
                made = {
                    "n_grams": pa.array(grams.astype(np.int64)), "log_weight": pa.array(weight),
                    "sample_key": pa.array(weight - np.log(-np.log(uniform))),
                }
                names = [n for n in part.schema.names if n not in ("text", "_chance")]
                yield pa.RecordBatch.from_arrays([made[n] if n in made else part.column(n) for n in names], names)

    return score


def _carried(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c.lower() not in ("text", *OUTPUT)]


def _scored(docs: DataFrame, target: DataFrame, seed: int) -> DataFrame:
    """``row`` (all columns but the text), n_grams, log_weight and sample_key (log weight plus Gumbel noise)."""
    ratios = log_ratios(gram_counts(target), gram_counts(docs))
    text = F.col("text").cast("string")
    rows = docs.select(
        text.alias("text"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), text).alias("_chance"),
        folded(_carried(docs)), F.lit(0).cast("long").alias("n_grams"), F.lit(0.0).alias("log_weight"), F.lit(0.0).alias("sample_key"),
    )
    return bounded(rows).mapInArrow(_scorer(ratios), rows.drop("text", "_chance").schema)


def scores(docs: DataFrame, target: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` without the text, with n_grams, log_weight and sample_key (log weight plus Gumbel noise)."""
    return unfolded(_scored(docs, target, seed), _carried(docs), *OUTPUT[:-1])


def resample(docs: DataFrame, target: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """:func:`scores` with ``kept``: whether the row is among the ``share`` of all rows with the largest keys."""
    scored = staged(_scored(docs, target, seed), "scores")
    wanted = round(share * scored.count())
    order = [F.col("sample_key").desc(), F.col("row")["doc_id"].asc_nulls_last()]
    ranked = running_totals(scored, order, {"_before": F.lit(1)})
    return unfolded(ranked.withColumn("kept", F.col("_before") < wanted), _carried(docs), *OUTPUT)
