"""Near-duplicate lines: a segment-partition edit join over the lines of all documents.

Two lines within ``edits`` insertions, deletions or replacements of bytes share one of the
``edits`` + 1 even segments of the shorter one, at a place that depends on both lengths. A line is
filed under the segments of its own length and looks up, for each length up to ``edits`` shorter, the substrings
that can be a segment there; length, segment number and substring hash form one key. What meets under a key is
confirmed by an edit distance whose band of diagonals sits in the bits of one machine word. Links
chain: the first line of a component, by document and line number, stays.

Lines end at line feeds. Blank lines stay. Lines shorter than ``least`` bytes are compared for equality
only. A line is known by a 64-bit hash. Rows: a null text has no lines, an empty one a single blank line. Rows that
repeat id and text are one document; rows that repeat the id alone are told apart by text. Documents
without id come last. Other columns are ignored whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .graph import components, link_through
from .tokens import _powers, bounded, mix, quoted, slices, unused

EDITS = 2
LEAST = 32
#: Bytes of the substrings that a line's parity sketches count: one sketch per length, of ``WORDS`` words of 64 bits.
GRAM = 4
GRAMS = (1, 2, 3, GRAM)
WORDS = 2
SKETCH = [f"sketch_{gram}_{k}" for gram in GRAMS for k in range(WORDS)]
#: Lines whose keys a task remembers having sent; sending one twice is harmless.
REMEMBERED = 100_000


def _hash(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little", signed=True)


def _lines(part: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """(row, line number, line) of all lines but blank ones."""
    for row, text in enumerate(part.column("text").to_pylist()):
        if text is not None:
            for number, line in enumerate(text.split(b"\n")):
                if line.strip():
                    yield row, number, line


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [(row, number, _hash(line)) for row, number, line in _lines(part)]
            row, number, node = (np.array(c, np.int64) for c in (zip(*found) if found else ([], [], [])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), *(part.column(c).take(pa.array(row)) for c in ("doc_id", "text_hash")), pa.array(number.astype(np.int32))],
                ["node", "doc_id", "text_hash", "line"],
            )


def _substrings(edits: int) -> list[tuple[int, int, int]]:
    """(how much shorter the other line is, segment, shift) of all substrings to look up."""
    wanted = []
    for shorter in range(edits + 1):
        for segment in range(edits + 1):
            low = max(-segment, shorter - (edits - segment))
            high = min(segment, shorter + (edits - segment))
            wanted += [(shorter, segment, shift) for shift in range(low, high + 1)]
    return wanted


def segment_keys(lines: list[bytes], edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the lines, all at least ``edits`` * 2 + 1 bytes long, and the line of each key."""
    data = np.frombuffer(b"".join(lines), np.uint8)
    sizes = np.array([len(x) for x in lines], np.int64)
    first = np.cumsum(sizes) - sizes
    power, inverse = _powers(len(data) + 1)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], dtype=np.uint64)]
    keys, owners = [], []
    for shorter, segment, shift in _substrings(edits):
        length = sizes - shorter
        each = length // (edits + 1)
        # The last segments are one byte longer when the length does not divide.
        short_ones = (edits + 1) - (length - each * (edits + 1))
        at = first + segment * each + np.maximum(segment - short_ones, 0) + shift
        size = each + (segment >= short_ones)
        fits = np.flatnonzero((at >= first) & (at + size <= first + sizes))
        a, b = at[fits], (at + size)[fits]
        own = (sums[b] - sums[a]) * inverse[a]
        keys.append(mix(own ^ (length[fits].astype(np.uint64) << np.uint64(8)) ^ np.uint64(segment)))
        owners.append(fits)
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _keyed(edits: int, least: int):
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                own: dict[int, bytes] = {}
                for _, _, line in _lines(part):
                    if len(line) >= least and (node := _hash(line)) not in sent:
                        own[node] = line
                if not own:
                    continue
                if len(sent) > REMEMBERED:
                    sent.clear()
                sent.update(own)
                keys, owner = segment_keys(list(own.values()), edits)
                nodes = np.array(list(own), np.int64)[owner]
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])

    return keyed


def sketches(lines: list[bytes], gram: int = GRAM) -> np.ndarray:
    """A bit per hash group of a line's ``gram``-byte substrings: whether the line has an odd number of them.

    An edit touches at most ``gram`` substrings before and as many after, each flipping one bit.
    """
    out = np.zeros((len(lines), WORDS), np.uint64)
    data = np.frombuffer(b"".join(lines), np.uint8)
    sizes = np.array([len(x) for x in lines], np.int64)
    first = np.cumsum(sizes) - sizes
    if len(data) >= gram:
        value = np.zeros(len(data) - gram + 1, np.uint64)
        for k in range(gram):
            value = value * np.uint64(257) + data[k: len(data) - gram + 1 + k]
        group = mix(value) >> np.uint64(57)
        bit = np.uint64(1) << (group & np.uint64(63))
        # Substrings that begin in one line and end in the next are left out.
        ends = np.minimum(first + np.maximum(sizes - gram + 1, 0), len(group))
        starts = np.minimum(first, ends)
        for k in range(WORDS):
            parity = np.r_[np.uint64(0), np.bitwise_xor.accumulate(np.where(group >> np.uint64(6) == k, bit, np.uint64(0)))]
            out[:, k] = parity[ends] ^ parity[starts]
    return out.view(np.int64)


def plausible(edits: int) -> str:
    """What the sketches of two lines (suffixes _a and _b) within ``edits`` edits satisfy."""
    return " AND ".join(
        "(" + " + ".join(f"bit_count(sketch_{gram}_{k}_a ^ sketch_{gram}_{k}_b)" for k in range(WORDS)) + f") <= {2 * gram * edits}"
        for gram in GRAMS
    )


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1 << 18):
            lines = part.column("text").to_pylist()
            words = [pa.array(w) for gram in GRAMS for w in np.ascontiguousarray(sketches(lines, gram).T)]
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("text"), *words], ["node", "text", *SKETCH])


def _texts(least: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                own: dict[int, bytes] = {}
                for _, _, line in _lines(part):
                    if len(line) >= least and (node := _hash(line)) not in sent:
                        own[node] = line
                if len(sent) > REMEMBERED:
                    sent.clear()
                sent.update(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.binary())], ["node", "text"]
                )

    return texts


def within(left: list[bytes], right: list[bytes], edits: int) -> np.ndarray:
    """Whether each pair is within ``edits`` edits; all pairs advance together, one byte a step.

    Bit d of a word stands for the diagonal that lies d - ``edits`` below the main one. The words hold where the
    distance rises and falls down the band (Hyyro's banded form of Myers' bit vectors); the
    distance itself is followed along the lowest diagonal, then up the last column.
    """
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in zip(left, right)]
    n, m = np.array([len(a) for a, _ in pairs], np.int64), np.array([len(b) for _, b in pairs], np.int64)
    result = np.zeros(len(pairs), bool)
    alive = np.flatnonzero(m - n <= edits)
    if not len(alive):
        return result
    width = 2 * edits + 1
    longest = int(m[alive].max())
    # Two different fillers, so bytes outside the lines never match.
    short = np.full((len(alive), longest + 2 * width), 300, np.int16)
    long = np.full((len(alive), longest), 400, np.int16)
    for row, i in enumerate(alive):
        a, b = pairs[i]
        short[row, width: width + len(a)] = np.frombuffer(a, np.uint8)
        long[row, : len(b)] = np.frombuffer(b, np.uint8)
    n, m = n[alive], m[alive]
    # Distances of one column of the band, from diagonal -edits to +edits; rows above the first count upwards.
    full = np.int64((1 << width) - 1)
    # Before the first column, cell d of the band is row d - edits and holds its distance from row 0.
    above = np.int64((1 << (edits + 1)) - 1)
    rising = np.full(len(alive), full & ~above)
    falling = np.full(len(alive), above & ~np.int64(1))
    score = np.full(len(alive), edits, np.int64)  # value of the lowest cell, row ``edits``
    value = np.where(m == 0, 0, 1 << 30)
    top = np.int64(1 << (width - 1))
    for j in range(longest):
        match = np.zeros(len(alive), np.int64)
        for d in range(width):
            match |= (short[:, width + j + d - edits] == long[:, j]).astype(np.int64) << d
        # Vertical differences move up by one bit as the band moves down by one row.
        vp, vn = rising >> 1, falling >> 1
        vp |= top
        zero = (((match & vp) + vp) ^ vp) | match | vn
        hp = vn | ~(zero | vp)
        hn = zero & vp
        # The lowest cell steps along its diagonal: it stays where the diagonal difference is zero, else rises.
        score += 1 - ((zero >> (width - 1)) & 1)
        rising = (hn << 1) | ~(zero | (hp << 1))
        falling = zero & (hp << 1)
        rising &= full
        falling &= full
        done = np.flatnonzero(m == j + 1)
        if len(done):
            # Row n of this column: go up from the lowest cell, row j + 1 + edits.
            cell = score[done].copy()
            for bit in range(width - 1, 0, -1):
                up = (j + 1 + bit - edits) > n[done]
                step = ((rising[done] >> bit) & 1) - ((falling[done] >> bit) & 1)
                cell -= np.where(up, step, 0)
            value[done] = cell
    result[alive] = value <= edits
    return result


def _comparer(edits: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in slices(batch, "text_a", 1 << 20):
                keep = within(half.column("text_a").to_pylist(), half.column("text_b").to_pylist(), edits)
                yield half.select(["a", "b"]).filter(pa.array(keep))

    return compare


def duplicate_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """Per document with lines to remove: doc_id, text_hash, removed (numbers of its lines, from 0, ascending)."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = staged(bounded(rows).mapInArrow(_place, f"node long, doc_id {kind}, text_hash long, line int"), "places")
    texts = rows.select("text")

    def load(wanted: DataFrame) -> DataFrame:
        own = bounded(texts).mapInArrow(_texts(least), "node long, text binary").join(wanted, "node", "left_semi")
        # Only lines that share a key with others are sketched.
        schema = "node long, text binary, " + ", ".join(f"{word} long" for word in SKETCH)
        return bounded(own.dropDuplicates(["node"])).mapInArrow(_sketched, schema)

    def verify(pairs: DataFrame, held: DataFrame) -> DataFrame:
        both = pairs
        for end in "ab":
            sketch = [F.col(word).alias(f"{word}_{end}") for word in SKETCH]
            both = both.join(held.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}"), *sketch), end)
        near = both.where(F.abs(F.length("text_a") - F.length("text_b")) <= edits).where(plausible(edits))
        near = near.select("a", "b", "text_a", "text_b")
        return bounded(near).mapInArrow(_comparer(edits), "a long, b long")

    keys = bounded(texts).mapInArrow(_keyed(edits, least), "key long, node long")
    linked = components(link_through(keys, load, verify, None, plausible(edits), SKETCH))
    # One row per place of a line that has another place or a near line.
    counts = places.groupBy("node").agg(F.count("*").alias("n"))
    repeated = counts.join(linked, "node", "left").where("n > 1 OR component IS NOT NULL").select(
        "node", F.coalesce("component", "node").alias("component")
    )
    held = staged(places.join(repeated, "node"), "repeated")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "line")
    firsts = held.groupBy("component").agg(F.min(place).alias("first"))
    later = held.join(firsts, "component").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def report(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed, removed."""
    text = F.col("text").cast("string")
    own = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_hash"),
        F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
    )
    found = duplicate_lines(docs, edits, least)
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & F.col("_hash").eqNullSafe(F.col("text_hash"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return own.join(found, same, "left").select(
        F.col("_id").alias("doc_id"), "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )


def apply(docs: DataFrame, removals: DataFrame) -> DataFrame:
    """``docs`` without the lines named in ``removals`` (from :func:`duplicate_lines`); all columns kept, whatever their names."""
    row_id, row_hash, numbers = (unused(docs.columns, c) for c in ("_id", "_hash", "removed"))
    found = removals.select(
        F.col("doc_id").alias(row_id), F.col("text_hash").alias(row_hash), F.col("removed").alias(numbers)
    )
    text = F.col("text").cast("string")
    same = F.col("doc_id").eqNullSafe(F.col(row_id)) & F.xxhash64(text).eqNullSafe(F.col(row_hash))
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(numbers, i)), "\n")
    whole = F.when(F.col(numbers).isNull(), text).otherwise(kept).alias("text")
    return docs.join(found, same, "left").select(*[whole if c == "text" else F.col(quoted(c)) for c in docs.columns])
