"""Near-duplicate documents by MinHash with tensored tables.

``COLLECTIONS`` small collections of ``PER_COLLECTION`` minhashes are computed. A
table's key combines two collections, so 24 minhashes serve 66 tables that would
need 264 if each had its own. Two documents with a similarity of 0.8 share a key
unless at most one of their collections agrees, which has a chance of about one in
ten thousand. Every candidate is confirmed on the full shingle sets.

Rows: a null or empty text, or one without words, has no shingles and is linked
with nothing. Rows with equal shingle sets are one node of the graph, however many
they are, so repeated rows and equal ids cost nothing and share a component. Columns
other than the named ones are ignored, so their names may be anything. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .graph import components, link_through
from .tokens import SPACED_WORDS, distinct_per_row, in_workers, mix, seeds, shingle_hashes, slices, token_hashes

#: Words of 64 bits in the parity sketch of a set.
SKETCH = [f"sketch_{k}" for k in range(8)]
COLLECTIONS = 12
PER_COLLECTION = 2


def _sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, rows = token_hashes(text, SPACED_WORDS)
    return distinct_per_row(*shingle_hashes(hashes, rows, width))


def _digests(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name the set of each row."""
    one, two = (
        np.r_[np.uint64(0), np.cumsum(mix(values ^ seed), dtype=np.uint64)] for seed in seeds(91, 2)
    )
    return (one[first[1:]] - one[first[:-1]]).view(np.int64), (two[first[1:]] - two[first[:-1]]).view(np.int64)


def _sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bit per hash group of shingles: whether the set has an odd number of them.

    Every shingle that only one of two sets has flips one bit, so the bits in which two
    sketches differ are at most the shingles in which the sets differ.
    """
    out = np.zeros((len(first) - 1, len(SKETCH)), np.uint64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    group = mix(values) >> np.uint64(55)
    np.bitwise_xor.at(out, (row, (group >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (group & np.uint64(63)))
    return out.view(np.int64)


def _signer(width: int):
    factors = seeds(7, COLLECTIONS * PER_COLLECTION)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, first = _sets(part.column("text"), width)
                counts = np.diff(first)
                some = np.flatnonzero(counts)
                starts = first[:-1][some]
                lows = np.zeros((len(some), len(factors)), np.uint64)
                for k, factor in enumerate(factors):
                    if len(some):
                        # The high half of a product is the well-mixed one.
                        lows[:, k] = np.minimum.reduceat(mix_high(values, factor), starts)
                # A collection is named by one value of its minhashes.
                named = lows.reshape(len(some), COLLECTIONS, PER_COLLECTION)
                joined = np.zeros((len(some), COLLECTIONS), np.uint64)
                for k in range(PER_COLLECTION):
                    joined = mix(joined * np.uint64(31) + named[:, :, k] + np.uint64(k))
                bounds = np.zeros(len(counts) + 1, np.int32)
                bounds[1:] = np.cumsum(np.where(counts > 0, COLLECTIONS, 0))
                one, two = _digests(values, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_hash"), pa.array(counts.astype(np.int64)), pa.array(one), pa.array(two),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(joined.reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "collections"],
                )

    return sign


def mix_high(values: np.ndarray, factor: np.uint64) -> np.ndarray:
    product = values * factor
    return product ^ (product >> np.uint64(32))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: ``doc_id``, size and name of its shingle set, and the collections' values."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    return in_workers(
        docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash")), _signer(width),
        f"doc_id {kind}, text_hash long, n_shingles long, set_a long, set_b long, collections array<long>",
    )


def _table_keys(nodes: DataFrame) -> DataFrame:
    of = F.col("collections")
    pairs = [
        F.xxhash64(F.lit(i * COLLECTIONS + j), of[i], of[j])
        for i in range(COLLECTIONS) for j in range(i + 1, COLLECTIONS)
    ]
    return nodes.select(F.explode(F.array(*pairs)).alias("key"), "node")


def _comparer(width: int, percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "text_a"):
                for part in slices(half, "text_b"):
                    left, lf = _sets(part.column("text_a"), width)
                    right, rf = _sets(part.column("text_b"), width)
                    keep = np.zeros(part.num_rows, bool)
                    for i in range(part.num_rows):
                        x, y = left[lf[i]: lf[i + 1]], right[rf[i]: rf[i + 1]]
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
                    yield part.select(["a", "b"]).filter(pa.array(keep))

    return compare


def _rare_first(width: int, percent: int):
    """Narrower keys: of every set, the rarest shingles it cannot miss with all of a similar set.

    A similar set shares at least ``percent`` of a set's n shingles, so of any
    n - ceil(n * percent / 100) + 1 of them it shares one. With the rarest taken, a passage
    or template that many documents hold stops being a key. ``size`` is the set's, ``shared``
    how many of its shingles another set has at all: no link can be made of more. The
    set with the smallest part of its own ranks first; among edited copies that is the original.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, first = _sets(part.column("text"), width)
                node = np.repeat(part.column("node").to_numpy(), np.diff(first))
                size = np.repeat(np.diff(first), np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(size), pa.array(values.view(np.int64))], ["node", "n", "key"]
                )

    def refine(held: DataFrame) -> DataFrame:
        rows = staged(in_workers(held.select("node", "text"), shingles, "node long, n long, key long"), "shingles")
        often = rows.groupBy("key").agg(F.count("*").alias("holders"))
        ranked = rows.join(often, "key").groupBy("node").agg(
            F.max("n").alias("size"), F.count_if(F.col("holders") > 1).alias("shared"),
            F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("all"),
        )
        least = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
        taken = ranked.select("node", "size", "shared", F.explode(F.slice("all", F.lit(1), least.cast("int"))).alias("s"))
        return taken.where("s.holders > 1").join(held.select("node", *SKETCH), "node").select(
            "s.key", "node", "size", "shared", (1 - F.col("shared") / F.col("size")).alias("rank"), *SKETCH
        )

    return refine


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component, component_id, kept.

    Words are runs of anything but ASCII white space, with A-Z read as a-z. Two rows
    are linked when ``100 * shared >= percent * all`` of their distinct shingles of
    ``width`` words (a shorter text is one shingle). ``component_id`` is the smallest
    doc_id reachable over links; rows without shingles stand alone. ``text_hash`` (xxhash64) tells
    rows apart that share an id, ``component`` groups whose smallest ids are equal or null; it is null for rows that stand alone.
    """
    signed = staged(signatures(docs, width), "signatures")
    sets = signed.where("n_shingles > 0").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_hash")).alias("holder"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("collections").alias("collections"),
    )
    nodes = staged(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    keys = _table_keys(nodes)
    links = link_through(
        keys, lambda wanted: _texts_of(docs, nodes.join(wanted, "node", "left_semi"), width),
        _verifier(width, percent), _rare_first(width, percent),
        # shared part / joint part >= percent / 100: the shared part is at most either set's ``shared``,
        # and the part that only one set has at least the bits in which the sketches differ.
        plausible=f"least(shared_a, shared_b) * {100 + percent} >= (size_a + size_b) * {percent} AND ("
        + " + ".join(f"bit_count({word}_a ^ {word}_b)" for word in SKETCH)
        + f") * {100 + percent} <= (size_a + size_b) * {100 - percent}",
    )
    found = components(links)
    named = nodes.join(found, "node", "left").select(
        "set_a", "set_b", "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "component").select("set_a", "set_b", "component", "component_id")
    alone = signed.where("n_shingles = 0").select(
        "doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id")
    )
    joined = signed.where("n_shingles > 0").join(named, ["set_a", "set_b"]).select(
        "doc_id", "text_hash", "n_shingles", "component", "component_id"
    )
    return joined.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node``, ``n_shingles``, ``text``: of every set one text that has it.

    A set names one row that has it by id and text, as any number of rows may share an id or lack one.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))
    same = F.col("_id").eqNullSafe(F.col("holder.doc_id")) & (F.col("_hash") == F.col("holder.text_hash"))
    paired = rows.join(nodes, same).select("node", "n_shingles", "set_a", "set_b", "text")

    def same_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, first = _sets(part.column("text"), width)
                one, two = _digests(values, first)
                right = (one == part.column("set_a").to_numpy()) & (two == part.column("set_b").to_numpy())
                words = [pa.array(w) for w in np.ascontiguousarray(_sketches(values, first).T)]
                own = [part.column(c) for c in ("node", "n_shingles", "text")]
                made = pa.RecordBatch.from_arrays([*own, *words], ["node", "n_shingles", "text", *SKETCH])
                yield made.filter(pa.array(right))

    schema = "node long, n_shingles long, text string, " + ", ".join(f"{word} long" for word in SKETCH)
    found = in_workers(paired, same_set, schema)
    return found.dropDuplicates(["node"])


def _verifier(width: int, percent: int):
    def verify(pairs: DataFrame, held: DataFrame) -> DataFrame:
        sizes = held.select("node", "n_shingles")
        sized = (
            pairs.join(sizes.select(F.col("node").alias("a"), F.col("n_shingles").alias("_na")), "a")
            .join(sizes.select(F.col("node").alias("b"), F.col("n_shingles").alias("_nb")), "b")
            .where(F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * percent).select("a", "b")
        )
        both = sized.join(held.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
            held.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return in_workers(both, _comparer(width, percent), "a long, b long")

    return verify
