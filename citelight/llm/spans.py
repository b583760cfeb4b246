"""Repeated passages: sliding spans of consecutive sentences, hashed and joined over all documents.

A sentence ends at a word that ends in ``.``, ``!``, ``?`` or a like mark of another script, or at a line feed. Sentences
of more than ``LONG`` words are cut further by winnowing: of every ``WINDOW`` consecutive words of the sentence, after
the one with the smallest hash (the last of equal ones), so that a passage put into the middle of a long sentence falls
into the same pieces wherever it stands. From every piece on, a span runs over at least ``PIECES`` pieces and ``WORDS``
words. Spans with equal words are repeats; the first, by document and place, stays, and the pieces under any other are removed.

No piece is longer than ``LONG`` words. The first ``LONG`` words of a passage hold a cut that is in all its copies, and so
do the following ones up to the last ``LONG``; three pieces fit between, so every passage of more than 50 words has a whole span.

Words are runs of anything but ASCII white space, A-Z read as a-z. In scripts without spaces (``tokens.unspaced``) every
character is cut off like a word and counts as a third of one; a passage of 70 such characters has a whole span. Rows: null and empty texts, and texts
shorter than one span, are never changed. Rows that repeat id and text are one document; rows that repeat the id
alone are told apart by text; documents without id come last. Input columns named like an output
column (in any case) are replaced, all others are carried along whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .tokens import SPACED_WORDS, _powers, bounded, bytes_of, folded, mix, slices, token_hashes, unfolded, unspaced

LONG = 12
WINDOW = 8
PIECES = 3
WORDS = 15
#: What a word counts, next to a character of a script without spaces.
WORD = 3
OUTPUT = ("n_pieces", "n_removed", "removed", "first_docs", "kept_text")

#: Bytes that end a sentence at the end of a word.
_ENDS = np.zeros(256, bool)
_ENDS[[33, 46, 63]] = True
#: The last two and three bytes of other marks that do.
_ENDS_2 = [int.from_bytes(c.encode()) for c in "\u0589\u061f\u06d4"]
_ENDS_3 = [int.from_bytes(c.encode()) for c in "\u0964\u0965\u104a\u104b\u1362\u17d4\u3002\uff01\uff0e\uff1f\uff61"]


def _before(values: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(values)]


def _ends_sentence(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the words that end before ``end`` end a sentence."""
    closes = _ENDS[data[end - 1]]
    other = np.flatnonzero(data[end - 1] >= 128)
    # The first byte of a character is at hand where its last byte is.
    two = data[end[other] - 2].astype(np.int64) << 8 | data[end[other] - 1]
    three = data[np.maximum(end[other] - 3, 0)].astype(np.int64) << 16 | two
    closes[other] = np.isin(two, _ENDS_2) | np.isin(three, _ENDS_3)
    return closes


def _winnow(hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The place of the smallest hash, the last of equal ones, of every ``WINDOW`` words of one group."""
    m = max(len(hashes) - WINDOW + 1, 0)
    least, place = hashes[:m].copy(), np.zeros(m, np.int64)
    for k in range(1, WINDOW):
        lower = hashes[k: k + m] <= least
        np.copyto(least, hashes[k: k + m], where=lower)
        place[lower] = k
    return (place + np.arange(m))[group[:m] == group[WINDOW - 1: WINDOW - 1 + m]]


def pieces(text: pa.Array) -> tuple[np.ndarray, ...]:
    """Word hashes, first byte of each word, the first word of each piece (and the end), the first piece of each row (and
    the end), the first byte of each row (and the end), what the words before each word count (and the end)."""
    hashes, start, end, rows = token_hashes(text, SPACED_WORDS, apart=True)
    data, row_bytes = bytes_of(text)
    n = len(hashes)
    if not n:
        return hashes, start, np.zeros(1, np.int64), np.zeros(len(rows), np.int64), row_bytes, np.zeros(1, np.int64)
    last = np.zeros(n, bool)
    last[rows[1:][rows[1:] > 0] - 1] = True
    feeds = _before(data == 10)
    until = np.r_[start[1:], len(data)]
    closes = last | _ends_sentence(data, end) | (feeds[until] > feeds[end])
    sentence = np.r_[0, np.cumsum(closes)[:-1]]
    long = np.flatnonzero(np.bincount(sentence)[sentence] > LONG)
    closes[long[_winnow(hashes[long], sentence[long])]] = True
    first_word = np.r_[0, np.flatnonzero(closes) + 1]
    counts = np.full(n, WORD)
    counts[np.searchsorted(start, unspaced(data)[0])] = 1
    return hashes, start, first_word, np.searchsorted(first_word, rows), row_bytes, _before(counts)


def spans(hashes: np.ndarray, first_word: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Key, row, first piece and end piece (in the row) of every span."""
    total = len(first_word) - 1
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    at = np.arange(total)
    before = counts[first_word]
    end = np.maximum(at + PIECES, np.searchsorted(before, before[:-1] + WORDS * WORD))
    fits = np.flatnonzero(end <= rows[1:][owner]) if total else at
    a, b = first_word[:-1][fits], first_word[np.minimum(end, total)][fits]
    power, inverse = _powers(len(hashes) + 1)
    sums = np.r_[np.uint64(0), np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64)]
    keys = mix((sums[b] - sums[a]) * inverse[a] ^ (b - a).astype(np.uint64))
    return keys.view(np.int64), owner[fits], fits - rows[:-1][owner[fits]], end[fits] - rows[:-1][owner[fits]]


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, _, first_word, rows, _, counts = pieces(part.column("text"))
            keys, owner, first, end = spans(hashes, first_word, rows, counts)
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys), part.column("doc_id").take(owner), part.column("text_hash").take(owner),
                    pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32)),
                ],
                ["key", "doc_id", "text_hash", "first", "end"],
            )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per document with repeats: doc_id, text_hash, covered (piece ranges, one after the other), first_docs (who has them first)."""
    text = F.col("text").cast("string")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = bounded(rows).mapInArrow(_emit, f"key long, doc_id {kind}, text_hash long, first int, end int")
    # Counted on the key alone, so the shuffle carries partial counts and a common passage costs one row per task.
    common = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    held = staged(found.join(common, "key"), "repeats")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", F.col("first"))
    origin = held.groupBy("key").agg(F.min(place).alias("origin"))
    later = held.join(origin, "key").where(~place.eqNullSafe(F.col("origin")))
    return later.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("first", "end"))).alias("covered"),
        F.array_sort(F.collect_set("origin.doc_id")).alias("first_docs"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, start, first_word, rows, row_bytes, _ = pieces(part.column("text"))
            text = part.column("text").cast(pa.binary()).to_pylist()
            covered = part.column("covered").to_pylist()
            n, removed, kept = np.diff(rows), [], []
            for row, own in enumerate(covered):
                gone = np.zeros(n[row], bool)
                for span in own or ():
                    gone[span["first"]: span["end"]] = True
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                removed.append(edges.tolist())
                if not len(edges):
                    kept.append(text[row])
                    continue
                # A piece reaches from its first word to the first word of the next piece.
                words = first_word[rows[row]: rows[row + 1] + 1][:-1]
                at = np.r_[start[words] - row_bytes[row], len(text[row])]
                cuts = [0, *at[edges].tolist(), len(text[row])]
                kept.append(b"".join(text[row][a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            made = {
                "n_pieces": pa.array(n.astype(np.int64)),
                "n_removed": pa.array([sum(r[1::2]) - sum(r[::2]) for r in removed], pa.int64()),
                "removed": pa.array(removed, pa.list_(pa.int64())),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
            names = [c for c in part.schema.names if c != "covered"]
            yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(c) for c in names], names)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with n_pieces, n_removed, removed (first and end piece of each removed stretch, one after the other),
    first_docs (documents that have the removed spans first) and kept_text."""
    names = [c for c in docs.columns if c.lower() not in OUTPUT]
    found = repeated_spans(docs).withColumnRenamed("first_docs", "firsts")
    text = F.col("text").cast("string")
    own = docs.select(
        folded([c for c in names if c != "text"]), text.alias("text"), F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash")
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_hash").eqNullSafe(F.col("text_hash"))
    rows = own.join(found, same, "left").select(
        "row", "text",
        F.lit(0).cast("long").alias("n_pieces"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<long>").alias("removed"),
        F.coalesce("firsts", F.array()).alias("first_docs"), F.lit(None).cast("string").alias("kept_text"), "covered",
    )
    return unfolded(bounded(rows).mapInArrow(_cut, rows.drop("covered").schema), names, *OUTPUT)
