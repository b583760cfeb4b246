"""Ranked lexical search by dense blocked matrix products.

Items are the queries, documents are ranked for each of them by whole-number impacts:

    weight of a term    floor(1000 * ln((2 N + 2) / (2 df + 1)))
    length of a document m = 100 - B + (B * n * N) div L
    score               sum over the item's terms of weight * ((10**9 * tf) div (1000 * tf + 20 * m))

N documents hold at least one term, L is the number of all their terms, n a document's own, df the documents
that hold a term and tf how often this one does.

* One pass over the texts keeps, per document, n and the frequencies of terms that some item has (the compact
  vocabulary). Whole texts are read; a term is known by a hash and then compared byte by byte.
* N, L and df are sums over these rows.
* Tasks of about ``TASK_ROWS`` documents go through them in ascending order of id, ``TILE_ROWS`` at a time. The impacts of a
  tile are a dense float64 matrix over the terms that the tile holds, cut into tiles of terms so narrow
  that no sum in the product with the items' weights reaches 2**53: every product is exact, and products of the term tiles
  are added as 64-bit integers.
* Of each tile only documents that beat an item's worst kept score are looked at. As ids ascend, an equal score never
  replaces a kept one, so the ``k`` best are exact with ties by ascending id. A task returns ``k`` rows an item
  at most, and a window over these rows takes the best.

Items go in blocks of at most ``BLOCK_TERMS`` pairs of an item and a term (or one item) and at most ``BLOCK_ITEMS``
items, which is what the driver and a task hold of them; every block is one pass over the texts.

Rows: a null text or one without a term has no terms; such an item has no result and such a document is not counted.
Repeated items are ranked one by one. Documents that share an id are ranked one by one as well; null ids come last. Columns other
than doc_id, item_id and text are ignored. An empty table of items or documents gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import staged
from .prefix import running_totals
from .tokens import LOWER, PLAIN_WORDS, bounded, bytes_of, slices, token_hashes

K = 50
#: Share of a document's length in its impacts, in hundredths.
B = 50
BLOCK_TERMS = 32_768
BLOCK_ITEMS = 1024
TASK_ROWS = 8192
TILE_ROWS = 512
#: Most terms of a tile of terms.
TILE_TERMS = 2048
_EXACT = 1 << 53
#: Upper bound of a term's impact.
_IMPACT = 1_000_000


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of every item."""
    for batch in batches:
        for part in slices(batch, "text"):
            text = part.column("text")
            data, _ = bytes_of(text)
            hashes, starts, ends, first = token_hashes(text, PLAIN_WORDS)
            found = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = {bytes(LOWER[data[s:e]]) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())}
                found.append([t.decode() for t in sorted(own)])
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(found, pa.list_(pa.string()))], ["item_id", "terms"])


class Vocabulary:
    """Numbers of terms, found by hash and confirmed by their bytes."""

    def __init__(self, terms: list[str]):
        column = pa.array(terms, pa.string())
        hashes, _, _, _ = token_hashes(column, PLAIN_WORDS, fold=False)
        if len(np.unique(hashes)) != len(terms):
            raise ValueError("two terms of the items have one hash")
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        data, starts = bytes_of(column)
        self.data, self.starts, self.sizes = data.copy(), starts[:-1], np.diff(starts)

    def numbers(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and number of every known term of the texts, and the number of all terms of each row."""
        hashes, starts, ends, first = token_hashes(text, PLAIN_WORDS)
        owner = np.repeat(np.arange(len(text)), np.diff(first))
        if not len(self.hashes) or not len(hashes):
            return owner[:0], owner[:0], np.diff(first)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[place] == hashes)
        number = self.order[place[hit]]
        same = self.sizes[number] == (ends - starts)[hit]
        data, _ = bytes_of(text)
        at, known, sizes = starts[hit], self.starts[number], self.sizes[number]
        for k in range(int(sizes.max(initial=0))):
            inside = np.flatnonzero(same & (k < sizes))
            same[inside] = LOWER[data[at[inside] + k]] == self.data[known[inside] + k]
        return owner[hit][same], number[same], np.diff(first)


def _postings(terms: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(terms)
        width = max(len(terms), 1)
        for batch in batches:
            for part in slices(batch, "text"):
                owner, number, sizes = vocabulary.numbers(part.column("text"))
                pair, tf = np.unique(owner * width + number, return_counts=True)
                offsets = pa.array(np.searchsorted(pair, np.arange(part.num_rows + 1) * width).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sizes.astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array((pair % width).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64))),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return count


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whole-number impact of a term that occurs ``tf`` times in a document of length ``m``."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def term_tiles(weights: np.ndarray) -> list[slice]:
    """Consecutive terms whose largest possible score stays below 2**53."""
    tiles, start, held = [], 0, 0
    for k, weight in enumerate(weights.tolist()):
        most = weight * _IMPACT
        if k > start and (held + most >= _EXACT or k - start >= TILE_TERMS):
            tiles.append(slice(start, k))
            start, held = k, 0
        held += most
    return [*tiles, slice(start, len(weights))]


def tile_scores(items: np.ndarray, weights: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
    """Scores of all items for a tile of documents, as 64-bit integers.

    ``items`` (items x terms) says which terms an item has. Only terms that the tile holds take part.
    """
    scores = np.zeros((len(items), rows), np.int64)
    used, place = np.unique(term, return_inverse=True)
    if not len(used):
        return scores
    own = weights[used]
    for tile in term_tiles(own):
        inside = (place >= tile.start) & (place < tile.stop)
        dense = np.zeros((tile.stop - tile.start, rows))
        dense[place[inside] - tile.start, row[inside]] = impact[inside]
        # Sums of whole numbers below 2**53 are exact in float64, in whatever order they are added.
        scores += ((items[:, used[tile]] * own[tile]) @ dense).astype(np.int64)
    return scores


class Best:
    """The ``k`` highest scores of every item so far; rows offered later lose ties."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.row = np.full((items, k), -1, np.int64)

    def offer(self, scores: np.ndarray, first: int) -> None:
        better = scores > self.score[:, -1:]
        for item in np.flatnonzero(better.any(axis=1)).tolist():
            at = np.flatnonzero(better[item])
            score = np.concatenate([self.score[item], scores[item, at]])
            row = np.concatenate([self.row[item], at + first])
            top = np.argsort(-score, kind="stable")[: self.k]
            self.score[item], self.row[item] = score[top], row[top]


def _scorer(numbers: np.ndarray, terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = np.zeros((len(numbers), len(weights)), bool)
        for item, own in enumerate(terms):
            items[item, own] = True
        best, ids, seen = Best(len(numbers), k), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(start, TILE_ROWS)
                n = part.column("n").to_numpy()
                m = 100 - B + (B * n * n_docs) // max(n_terms, 1)
                held, tf = part.column("terms"), part.column("tfs").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy())
                scores = tile_scores(items, weights, row, held.flatten().to_numpy(), impacts(tf, m[row]), part.num_rows)
                best.offer(scores, seen)
                ids.append(part.column("doc_id"))
                seen += part.num_rows
        if not seen:
            return
        item, place = np.nonzero(best.score > 0)
        found = pa.concat_arrays(ids).take(pa.array(best.row[item, place]))
        columns = [pa.array(numbers[item]), found, pa.array(best.score[item, place])]
        yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return rank


def _blocks(items: DataFrame) -> DataFrame:
    """Items with their terms, numbered and dealt to blocks of bounded size."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    terms = bounded(rows).mapInArrow(_terms, f"item_id {kind}, terms array<string>").where("size(terms) > 0")
    terms = staged(terms.withColumn("number", F.monotonically_increasing_id()), "items")
    cost = F.greatest(F.size("terms"), F.lit(BLOCK_TERMS // BLOCK_ITEMS))
    summed = running_totals(terms, [F.col("number")], {"before": cost})
    return staged(summed.withColumn("block", F.expr(f"before div {BLOCK_TERMS}")), "blocks")


def search(items: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank (from 1), doc_id, score."""
    blocks = _blocks(items)
    found = [
        _search_block(blocks.where(F.col("block") == row["block"]), docs, k)
        for row in blocks.select("block").distinct().orderBy("block").collect()
    ]
    made = StructType([
        StructField("item_id", items.schema["item_id"].dataType), StructField("rank", IntegerType()),
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("score", LongType()),
    ])
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], made)


def _search_block(block: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    held = block.select("number", "terms").collect()  # at most BLOCK_TERMS terms, or one item
    terms = sorted({t for row in held for t in row["terms"]})
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    postings = staged(
        bounded(rows).mapInArrow(_postings(terms), f"doc_id {kind}, n long, terms array<int>, tfs array<long>").where("n > 0"),
        "postings",
    )
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(terms))], np.int64)
    place = {t: i for i, t in enumerate(terms)}
    own = [np.array([place[t] for t in row["terms"]], np.int64) for row in held]
    numbers = np.array([row["number"] for row in held], np.int64)
    tasks = max(1, -(-n_docs // TASK_ROWS))
    dealt = postings.where("size(terms) > 0").coalesce(tasks).sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    scored = bounded(dealt).mapInArrow(
        _scorer(numbers, own, weights, n_docs, n_terms, k), f"number long, doc_id {kind}, score long"
    )
    by_item = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = scored.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
    return top.join(block.select("item_id", "number"), "number").select("item_id", "rank", "doc_id", "score")
