"""Hierarchical language identification: the family first, then one-versus-one SVMs within it.

Features are relative frequencies of hashed byte n-grams of the whole text (A-Z read as
a-z, digits left out). A linear SVM per family, one against the rest, names the family; within it a
linear SVM for each pair of languages votes. All are trained by Spark on at most
``ROWS_PER_LANGUAGE`` labelled rows of each language, those with the smallest random keys.

Rows: a null text, or one without any letter, gets ``und`` with score 0. Rows without a
label are not learned from. With no language learned every row gets ``und``; with a single one
every text with a letter gets that one. Rows that repeat are predicted one by one.
Input columns named like an output column are replaced, all others are carried along whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from ..session import staged
from .tokens import LOWER, bytes_of, folded, in_workers, mix, slices, unfolded

ROWS_PER_LANGUAGE = 1000
DIMENSIONS = 4096
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Bytes and rows whose n-grams are counted at a time.
SLICE = (1 << 20, 256)
#: Sampled rows up to which their keys go to all tasks.
FEW_KEYS = 100_000

#: Families of language codes. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "celtic": "ga cy gd br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky tt",
    "semitic": "ar he mt am",
    "iranian": "fa ku ps tg",
    "indic": "hi bn ur mr gu pa ne si",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv mg",
    "sinitic": "zh yue",
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), language)


def shares(text: pa.Array) -> np.ndarray:
    """A row per text: the share of its n-grams in each of the ``DIMENSIONS`` slots, scaled to a mean square near 1."""
    data, rows = bytes_of(text)
    n = len(rows) - 1
    owner = np.repeat(np.arange(n), np.diff(rows))
    digit = (data >= 48) & (data <= 57)
    data, owner = LOWER[data[~digit]], owner[~digit]
    counts = np.zeros(n * DIMENSIONS, np.int64)
    for order in ORDERS:
        if len(data) < order:
            continue
        gram = np.zeros(len(data) - order + 1, np.uint32)
        for k in range(order):
            gram = gram * np.uint32(257) + data[k: len(data) - order + 1 + k]
        inside = owner[order - 1:] == owner[: len(owner) - order + 1]
        spread = gram * np.uint32(2654435761) + np.uint32(order)
        slot = (spread >> np.uint32(20)).astype(np.int64) + owner[order - 1:] * DIMENSIONS
        counts += np.bincount(slot[inside], minlength=n * DIMENSIONS)
    counts = counts.reshape(n, DIMENSIONS)
    return np.sqrt(DIMENSIONS) * counts / np.maximum(counts.sum(axis=1), 1)[:, None]


@dataclass
class Model:
    """Weights by slot (with the intercept last) of every family and of every pair of languages in a family."""

    languages: list[str]
    families: list[str]
    family_weights: np.ndarray
    pairs: list[tuple[int, int]]
    pair_weights: np.ndarray


def sample(labelled: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """At most ``rows`` labelled texts of each language, chosen by a hash of the text."""
    known = labelled.select("lang", F.col("text").cast("string").alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    by_key = Window.partitionBy("lang").orderBy("_key")
    keys = known.select("lang", F.xxhash64("text").alias("_key")).distinct()
    chosen = keys.withColumn("_place", F.row_number().over(by_key)).where(F.col("_place") <= rows).drop("_place")
    chosen = staged(chosen, "chosen")
    if chosen.count() <= FEW_KEYS:
        chosen = F.broadcast(chosen)
    same = known.withColumn("_key", F.xxhash64("text")).join(chosen, ["lang", "_key"], "left_semi")
    return same.dropDuplicates(["lang", "_key"]).select("lang", "text")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", *SLICE):
            own = shares(part.column("text"))
            bounds = np.arange(len(own) + 1, dtype=np.int32) * DIMENSIONS
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(own.reshape(-1)))],
                ["lang", "shares"],
            )


def _separate(rows: DataFrame, positive) -> np.ndarray:
    """Weights and intercept of a linear SVM for the rows where ``positive`` holds against the others."""
    svm = LinearSVC(maxIter=30, regParam=1e-3, standardization=False, aggregationDepth=2)
    fitted = svm.fit(rows.withColumn("label", positive.cast("double")))
    return np.r_[fitted.coefficients.toArray(), fitted.intercept]


def train(labelled: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from ``labelled`` (text, lang)."""
    vectors = staged(in_workers(sample(labelled, rows).repartition(F.xxhash64("text")), _vectors, "lang string, shares array<double>"), "shares")
    languages = sorted(r[0] for r in vectors.select("lang").distinct().collect())
    families = sorted({family_of(x) for x in languages})
    shaped = vectors.select("lang", array_to_vector("shares").alias("features")).cache()
    members = {f: [i for i, x in enumerate(languages) if family_of(x) == f] for f in families}
    none = np.zeros((0, DIMENSIONS + 1))
    of_family = [
        _separate(shaped, F.col("lang").isin([languages[i] for i in members[f]])) for f in families
    ] if len(families) > 1 else []
    pairs = [p for f in families for p in itertools.combinations(members[f], 2)]
    of_pair = [
        _separate(shaped.where(F.col("lang").isin(languages[a], languages[b])), F.col("lang") == languages[a])
        for a, b in pairs
    ]
    shaped.unpersist()
    return Model(
        languages, families, np.array(of_family) if of_family else none, pairs, np.array(of_pair) if of_pair else none
    )


def _predictor(model: Model):
    weights = np.concatenate([model.family_weights, model.pair_weights])
    tables, intercepts = weights[:, :DIMENSIONS], weights[:, DIMENSIONS]
    names = np.array(model.languages + [UNKNOWN], object)
    home = np.array([model.families.index(family_of(x)) for x in model.languages], np.int64)
    n_family = len(model.family_weights)

    def chance(margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", *SLICE):
                n = part.num_rows
                margins = tables @ shares(part.column("text")).T + intercepts[:, None]
                if n_family:
                    family = margins[:n_family].argmax(axis=0)
                    score = chance(margins[:n_family].max(axis=0))
                else:
                    family, score = np.zeros(n, np.int64), np.ones(n)
                votes = np.zeros((n, len(model.languages)))
                worst = np.ones((n, len(model.languages)))
                for (a, b), margin in zip(model.pairs, margins[n_family:]):
                    sure = chance(margin)
                    votes[:, a] += margin > 0
                    votes[:, b] += margin <= 0
                    worst[:, a] = np.minimum(worst[:, a], sure)
                    worst[:, b] = np.minimum(worst[:, b], 1 - sure)
                # Votes count within the family; equal votes go to the language surer of its worst contest.
                rank = np.where(home[None, :] == family[:, None], votes + worst / 2, -1.0)
                best = rank.argmax(axis=1) if len(model.languages) else np.zeros(n, np.int64)
                if len(model.languages):
                    score = score * worst[np.arange(n), best]
                lettered = part.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                some = lettered & (len(model.languages) > 0)
                made = {
                    "lang_pred": pa.array(np.where(some, names[best], UNKNOWN), pa.string()),
                    "score": pa.array(np.where(some, score, 0.0)),
                }
                out = part.schema.names
                yield pa.RecordBatch.from_arrays([made.get(c, part.column(i)) for i, c in enumerate(out)], out)

    return predict


def predict(model: Model, docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with ``lang_pred`` and ``score`` (0 to 1); only the text is looked at."""
    names = [c for c in docs.columns if c.lower() not in ("text", "lang_pred", "score")]
    text = F.col("text").cast("string")
    rows = docs.select(
        text.alias("text"), folded(names), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return unfolded(in_workers(rows, _predictor(model), rows.schema), ["text", *names], "lang_pred", "score")
