"""Token hashes of whole texts, computed on the bytes of an Arrow column.

A token is a longest run of bytes of one class (0 separates tokens). Texts are
UTF-8, so the classes used here never cut a character. All functions are
vectorised over a slice of rows; a slice holds at most ``SLICE_BYTES`` of text or
a single row.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SLICE_BYTES = 1 << 20
#: Bytes of rows that Spark hands to a worker at a time.
BATCH_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but space and the controls 9 to 13 belongs to a word.
SPACED_WORDS = np.ones(256, np.uint8)
SPACED_WORDS[[32, 9, 10, 11, 12, 13]] = 0

#: Digits, letters and every byte of a non-ASCII character.
PLAIN_WORDS = np.zeros(256, np.uint8)
PLAIN_WORDS[48:58] = PLAIN_WORDS[65:91] = PLAIN_WORDS[97:123] = PLAIN_WORDS[128:] = 1

#: Words as above, and runs of other visible characters as tokens of their own.
WORDS_AND_MARKS = SPACED_WORDS.copy() * 2
WORDS_AND_MARKS[PLAIN_WORDS == 1] = 1
WORDS_AND_MARKS[:32] = WORDS_AND_MARKS[127] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(label: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(label)) | np.uint64(1)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        _POWERS[:] = [
            np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
            for base in (_ODD, _ODD_INVERSE)
        ]
    return _POWERS[0], _POWERS[1]


def bounded(rows: DataFrame) -> DataFrame:
    """``rows``, to be handed to workers in batches of at most ``BATCH_BYTES`` or a single row.

    By default a batch holds 64 MB, which the JVM and the worker both keep in memory. The setting is the
    session's and stays, because a plan reads it when it runs.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return rows


#: What this process keeps from one task to the next, by owner.
_KEPT: dict[str, object] = {}


def keep(owner: str, make: Callable[[], object]):
    """What ``make`` returns, made once per process and kept for later tasks of the same owner (see :func:`in_workers`)."""
    if owner not in _KEPT:
        _KEPT[owner] = make()
    return _KEPT[owner]


def let_go(owner: str = "") -> None:
    """Forget what other owners keep in this process."""
    for name in [name for name in _KEPT if name != owner]:
        del _KEPT[name]


def give_back() -> None:
    """Return memory that this process no longer uses, so that a worker that waits for its next task is small."""
    if _POWERS and len(_POWERS[0]) > SLICE_BYTES + (1 << 16):
        _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, other C libraries need not
    if trim is not None:
        trim(0)


def in_workers(rows: DataFrame, function: Callable, schema, owner: str = "") -> DataFrame:
    """``mapInArrow`` over :func:`bounded` rows, in workers that hold nothing of other operators.

    Spark uses a worker process again, also for other queries, and keeps it for a while if it has nothing to do. What another
    operator left there is forgotten before the task, and freed memory goes back to the machine after it.
    """
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(owner)
        try:
            yield from function(batches)
        finally:
            give_back()

    return bounded(rows).mapInArrow(tidy, schema)


def unused(names, wanted: str) -> str:
    """``wanted``, with as many underscores behind it as make it differ from all ``names`` in any case."""
    taken = {name.lower() for name in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, also with points or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def folded(names: Sequence[str]) -> Column:
    """The columns ``names`` as one value ``row``: whatever they are called, no name of theirs meets another."""
    filler = F.lit(None).cast("int").alias(unused(names, "_"))
    return F.struct(filler, *[F.col(quoted(c)) for c in names]).alias("row")


def unfolded(rows: DataFrame, names: Sequence[str], *more: str) -> DataFrame:
    """The columns ``names``, ``text`` as ``rows`` has it and the others from ``row``; then ``more``."""
    own = [F.col(c) if c == "text" else F.col("row")[c].alias(c) for c in names]
    return rows.select(*own, *more)


def slices(
    batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, cut where the text column reaches ``limit`` bytes or there are ``rows``."""
    text = batch.column(column)
    sizes = np.diff(offsets_of(text)) if len(text) else np.zeros(0, np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and (held + size > limit or row - start >= rows):
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(text):
        yield batch.slice(start)


def offsets_of(text: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array, absolute in its data buffer."""
    kind = np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32
    raw = np.frombuffer(text.buffers()[1], kind)
    return raw[text.offset: text.offset + len(text) + 1].astype(np.int64)


def bytes_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows one after the other, and each row's start (and the end)."""
    ends = offsets_of(text)
    data = text.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), ends * 0
    return np.frombuffer(data, np.uint8)[ends[0]: ends[-1]], ends - ends[0]


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every character of a script written without spaces.

    These are Thai, Lao, Tibetan, Burmese, Khmer, and all from CJK marks and kana to ideographs, with their wide forms.
    """
    at = np.flatnonzero(data >= 0xE0)
    padded = np.r_[data, np.zeros(2, np.uint8)]
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    found = (
        (a == 0xE0) & (b >= 0xB8)
        | (a == 0xE1) & ((b <= 0x81) | (b == 0x82) & (c < 0xA0) | (b == 0x9E) | (b == 0x9F))
        | (a >= 0xE3) & (a <= 0xE9)
        | (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b >= 0xBC) & (b <= 0xBE))
        | (a == 0xF0) & (b >= 0xA0)
    )
    return at[found], at[found] + np.where(a[found] == 0xF0, 4, 3)


def token_hashes(
    text: pa.Array, classes: np.ndarray, fold: bool = True, apart: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and last byte (exclusive) of every token, and the first token of each row (and the end).

    ``fold`` reads A-Z as a-z; ``apart`` makes every character of a script without spaces a token. A null row has no tokens.
    """
    data, rows = bytes_of(text)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(rows), np.int64)
    kind = classes[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[rows] = True
    if apart:
        for edges in unspaced(data):
            change[np.minimum(edges, len(data))] = True
    cuts = np.flatnonzero(change)
    starts, ends = cuts[:-1], cuts[1:]
    inside = kind[starts] > 0
    starts, ends = starts[inside], ends[inside]
    power, inverse = _powers(len(data))
    values = (LOWER[data] if fold else data).astype(np.uint64)
    values += np.uint64(1)
    values *= power[: len(data)]
    sums = np.cumsum(values, dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends - 1] - before) * inverse[starts] ^ (ends - starts).astype(np.uint64) * _ODD)
    return hashes, starts, ends, np.searchsorted(starts, rows)


def shingle_hashes(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive tokens of each row, with each row's first shingle (and the end).

    A row of fewer tokens, but not none, has one shingle of all of them.
    """
    counts = np.diff(rows)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.r_[0, np.cumsum(made)]
    owner = np.repeat(np.arange(len(counts)), made)
    at = rows[:-1][owner] + (np.arange(first[-1]) - first[:-1][owner])
    out = np.zeros(len(at), np.uint64)
    short = counts[owner] < width
    last = len(hashes) - 1
    for k, odd in enumerate(seeds(width, width)):
        step = hashes[np.minimum(at + k, last)] * odd if last >= 0 else out
        # A missing word counts as a fixed value that no hash of a present word shares by construction of its place.
        out += np.where(short & (k >= counts[owner]), odd, step) if short.any() else step
    return mix(out), first


def distinct_per_row(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row in ascending order, with each row's first (and the end)."""
    out, sizes = [], [0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        own = np.unique(hashes[a:b])
        out.append(own)
        sizes.append(len(own))
    return (np.concatenate(out) if out else hashes), np.cumsum(sizes)
