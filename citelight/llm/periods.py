"""Runs of repeated word groups, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period ``q`` that is at least ``LEAST`` words and
``EXPONENT`` periods long and that no neighbouring word extends. Texts are numbered words; the texts of a
slice lie one after the other with a unique mark between them and are searched together:

* Periods below ``2 * SMALLEST`` words are seen directly, by comparing every word with the one a period later.
* At scale t (``SMALLEST`` and its doublings) every fragment of t words has a hash, and a position is
  *synchronising* if the smallest hash among the t + 1 fragments from it on is the first or the last of them.
  Fragments inside highly periodic regions (period at most t / 3, known from below) do not take part, so
  equal fragments lie apart and the set is sparse. Whether a position is chosen depends on the 2t words after
  it alone, and each stretch of 3t - 1 words that is not highly periodic has one among its first t. A run with a
  period of 2t to 4t words therefore has two chosen positions one period apart with the same following 3t
  words (periods below 3t) or 4t words. These words are no shorter than the period, so no further
  place between them has the same ones: neighbours among the positions of equal context propose all periods.
* A proposed period is extended word by word in both directions and kept if it is a run with no shorter period. Hashes
  only propose; words are compared as numbers that stand for exact words.

Work and memory are in proportion to the text and the number of scales; a text is never cut, and a slice of rows holds
``tokens.SLICE_BYTES`` or one text. Nothing is shuffled.

Rows: a null, empty or wordless text has no run; its text stays as it is. Rows do not meet each other, so repeats,
ties and null ids have no effect. An input column named ``runs`` or ``collapsed`` (in any case) is replaced; all
others are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .tokens import bounded, mix, slices

#: Shortest run in words, and in periods.
LEAST = 24
EXPONENT = 3
#: Words of a fragment at the finest scale.
SMALLEST = 4
RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])

_BASE = 0x9E3779B97F4A7C15
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = 1 << max(n - 1, 1 << 16).bit_length()
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return known


class _Fragments:
    """Hashes of any fragments of a sequence of numbers, by prefix sums."""

    def __init__(self, codes: np.ndarray):
        values = mix(codes.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(codes))[: len(codes)]
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), len(codes))

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        return mix((self.sums[places + size] - self.sums[places]) * self.inverse[places])

    def all(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def stretches(codes: np.ndarray, period: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every longest stretch of at least ``least`` words with this period."""
    same = np.zeros(max(len(codes) - period, 0) + 2, np.int8)
    np.equal(codes[:-period], codes[period:], out=same[1:-1], casting="unsafe")
    edges = np.flatnonzero(same[1:] != same[:-1])
    start, end = edges[::2], edges[1::2] + period
    long = end - start >= least
    return start[long], end[long]


def extended(codes: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """The longest stretch with this period around the word pair (place, place + period)."""
    end, step = place, 32
    while end + period < len(codes):
        differs = codes[end: end + step] [: len(codes) - end - period] != codes[end + period: end + period + step]
        if differs.any():
            end += int(differs.argmax())
            break
        end += len(differs)
        step *= 2
    start, step = place, 32
    while start > 0:
        low = max(start - step, 0)
        differs = (codes[low: start] != codes[low + period: start + period])[::-1]
        if differs.any():
            start -= int(differs.argmax())
            break
        start = low
        step *= 2
    return start, end + period


def _prime_divisors(n: int) -> list[int]:
    found, d = [], 2
    while d * d <= n:
        if n % d == 0:
            found.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return found + [n] * (n > 1)


def smallest(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of two periods or more from ``start`` on has no shorter period that divides this one."""
    word = codes[start: start + 2 * period]
    return all((word[: -(period // d)] != word[period // d:]).any() for d in _prime_divisors(period))


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every ``size`` + 1 consecutive values, ``size`` a power of two."""
    held, width = values, 1
    while width < size:
        held = np.minimum(held[:-width], held[width:])
        width *= 2
    return np.minimum(held[:-1], held[1:])


def synchronising(fragments: _Fragments, scale: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Chosen positions at a scale; ``start`` and ``end`` bound the highly periodic regions."""
    hashes = fragments.all(scale)
    if len(hashes) <= scale:
        return np.zeros(0, np.int64)
    if len(start):
        depth = np.zeros(len(hashes) + 1, np.int32)
        np.add.at(depth, start, 1)
        np.add.at(depth, end - scale + 1, -1)
        hashes[np.cumsum(depth[:-1]) > 0] = _LAST
    least = _window_min(hashes, scale)
    chosen = (least == hashes[: len(least)]) | (least == hashes[scale:])
    return np.flatnonzero(chosen & (least != _LAST))


def proposals(fragments: _Fragments, places: np.ndarray, total: int, scale: int) -> list[tuple[int, int]]:
    """(period, place) of neighbouring chosen positions with equal contexts, in ascending order."""
    found = []
    for size in (3 * scale, 4 * scale):
        inside = places[places + size <= total]
        context = fragments.at(inside, size)
        order = np.argsort(context, kind="stable")
        place, context = inside[order], context[order]
        gap = np.diff(place)
        # Contexts of 3 t words speak for periods from 2 t on, those of 4 t words from 3 t on.
        hit = (context[1:] == context[:-1]) & (gap >= size - scale) & (gap < size)
        found.append(np.stack([gap[hit], place[:-1][hit]], axis=1))
    return sorted(map(tuple, np.concatenate(found).tolist()))


def _layout(codes: np.ndarray, first: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts, a unique mark after each, and where each begins."""
    sizes = (first[1:] - first[:-1])[texts]
    begins = np.cumsum(sizes + 1) - sizes - 1
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(texts)), sizes)
    within = np.arange(total) - (begins - np.arange(len(texts)))[owner]
    out = np.empty(total + len(texts), np.int64)
    out[begins[owner] + within] = codes[first[texts][owner] + within]
    out[begins + sizes] = (1 << 62) + np.arange(len(texts))
    return out, begins


def find_runs(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in ascending order.

    ``codes`` are non-negative numbers of the words of all texts, ``first`` each text's first word (and the end).
    """
    sizes = np.diff(first)
    texts = np.flatnonzero(sizes >= LEAST)
    if not len(texts):
        return np.zeros((0, 4), np.int64)
    held, begins = _layout(codes, first, texts)
    known = []  # text, start in it, end in it, period of all regions that are highly periodic at some scale
    for period in range(1, 2 * SMALLEST):
        scale = SMALLEST
        while scale < EXPONENT * period:
            scale *= 2
        start, end = stretches(held, period, min(scale, LEAST))
        for s, e in zip(start.tolist(), end.tolist()):
            if e - s >= 2 * period and smallest(held, s, period):
                text = int(np.searchsorted(begins, s, "right")) - 1
                known.append((int(texts[text]), s - int(begins[text]), e - int(begins[text]), period))
    scale = SMALLEST
    while True:
        able = np.flatnonzero(sizes >= 2 * EXPONENT * scale)
        if not len(able):
            break
        if len(able) < len(texts):
            texts = able
            held, begins = _layout(codes, first, texts)
            fragments = None
        if scale == SMALLEST or fragments is None:
            fragments = _Fragments(held)
        regions = [
            (begins[at] + s, begins[at] + e) for text, s, e, p in known if 3 * p <= scale <= e - s
            for at in [np.searchsorted(texts, text)] if at < len(texts) and texts[at] == text
        ]
        start, end = np.array(regions, np.int64).reshape(-1, 2).T
        places = synchronising(fragments, scale, start, end)
        before = (0, 0)
        for period, place in proposals(fragments, places, len(held), scale):
            if before[0] == period and place + period < before[1]:
                continue
            s, e = extended(held, place, period)
            before = (period, e)
            if e - s >= max(LEAST, EXPONENT * period) and smallest(held, s, period):
                text = int(np.searchsorted(begins, s, "right")) - 1
                known.append((int(texts[text]), s - int(begins[text]), e - int(begins[text]), period))
        scale *= 2
    runs = sorted((t, s, e - s, p) for t, s, e, p in known if e - s >= max(LEAST, EXPONENT * p))
    return np.array(runs, np.int64).reshape(-1, 4)


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds beyond its first period, with one space between them."""
    depth = np.zeros(len(words) + 1, np.int64)
    for _, start, length, period in runs.tolist():
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        for part in slices(batch, "text"):
            # Splitting bytes cuts at the ASCII space and the controls 9 to 13 alone.
            texts = part.column("text").cast(pa.binary()).to_pylist()
            per_text = [t.split() if t else [] for t in texts]
            first = np.cumsum([0, *map(len, per_text)])
            flat = [w for words in per_text for w in words]
            numbers: dict[bytes, int] = {}
            codes = np.fromiter(map(numbers.setdefault, flat, range(len(flat))), np.int64, len(flat))
            runs = find_runs(codes, first)
            bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
            found, joined = [], []
            for row, words in enumerate(per_text):
                own = runs[bounds[row]: bounds[row + 1]]
                found.append([{"start": s, "length": n, "period": p} for _, s, n, p in own.tolist()])
                joined.append(_collapsed(words, own) if len(own) else b" ".join(words))
            columns = {name: part.column(name) for name in part.schema.names if name != "text"}
            columns |= {"runs": pa.array(found, kind), "collapsed": pa.array(joined, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_pydict(columns)


def detect(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``runs`` and ``collapsed``.

    ``runs`` lists start, length and period in words, by start and then period; ``collapsed`` is the text with one
    space between words and without the words that repeat a run's first period (empty for a null text).
    """
    carried = [c for c in docs.columns if c.lower() not in ("text", "runs", "collapsed")]
    row = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.struct(F.lit(None).alias("_none"))
    rows = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    made = StructType([rows.schema["row"], StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
    found = bounded(rows).mapInArrow(_search, made)
    return found.select(*[F.col("row")[c].alias(c) for c in carried], "runs", "collapsed")
