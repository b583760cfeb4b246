"""Benchmark passages in training text, found with suffix arrays of the text.

Each task cuts its documents into shards of words, builds the suffix array of a shard
and binary-searches every suffix of the benchmark items in it. The search narrows the
interval of matching suffixes word by word, so it ends with the longest verbatim match and all
its places; the interval at the length of a window gives the places of the window. The
benchmark goes to the tasks in blocks of bounded size, one pass over the text per block.
Nothing is shuffled.

A word is a run of digits, letters a-z (A-Z are read as such) and non-ASCII characters. A
window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one
window. Rows: null and empty texts have no words and no hits. Rows that repeat ids are judged
one by one; items that share an item_id count once, and an item without id counts but is not
named. An empty benchmark or table leaves every document clean. Input columns named like an
output column (in any case) are replaced; all others are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tokens import PLAIN_WORDS, folded, in_workers, slices, token_hashes, unfolded

#: Words of one suffix array; three ranks of it fit into 63 bits.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark text that go to the tasks at once.
BLOCK_BYTES = 8 << 20
#: Bytes of text that are searched at once.
SLICE_BYTES = 4 << 20
OUTPUT = ("n_words", "n_hit", "n_items", "items", "longest_match", "spans")
_FIELDS = (
    "n_words long, n_hit long, n_items long, items array<string>, longest_match long, spans array<long>"
)


@dataclass
class Items:
    """The words of a block of items, one after the other, and the distinct windows in them."""

    words: np.ndarray
    left: np.ndarray  # words from here to the end of the item
    window: np.ndarray  # length of the window that starts here, 0 if none
    name: np.ndarray  # number of the distinct window that starts here, -1 if none or seen before
    holders: list[list[str]]  # ids of the items that have each distinct window; None for an item without id


def read_items(texts: list[str | None], ids: list[str | None], width: int) -> Items:
    named: dict[str, list] = {}
    for text, item in zip(texts, ids):
        named.setdefault(text or "", []).append(item)
    same = list(named.values())
    hashes, _, _, first = token_hashes(pa.array(list(named), pa.string()), PLAIN_WORDS)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A match is followed over half a shard at most, so shards can overlap by the longest one.
    left = np.minimum(first[1:][owner] - np.arange(len(hashes)), SHARD_WORDS // 2)
    window = np.where(left >= width, width, 0)
    whole = first[:-1][(sizes > 0) & (sizes < width)]
    window[whole] = left[whole]
    name = np.full(len(hashes), -1)
    holders: list[list] = []
    seen: dict[bytes, int] = {}
    for at in np.flatnonzero(window).tolist():
        own = hashes[at: at + window[at]].tobytes()
        known = seen.get(own)
        if known is None:
            known = seen[own] = name[at] = len(holders)
            holders.append([])
        holders[known].extend(same[owner[at]])
    return Items(hashes, left, window, name, [sorted(set(h), key=lambda i: (i is None, i)) for h in holders])


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` (0 and up, fewer than 2**21) in the order of the first ``depth`` codes from there.

    Ranks of one, three, nine, ... codes are combined three at a time; from the second
    round on only positions that still tie are sorted again.
    """
    n = len(codes)
    rank, reach = codes.astype(np.int64) + 1, 1
    order, open_slots = np.arange(n), np.arange(n)
    while len(open_slots) and (reach < depth or reach == 1):
        padded = np.r_[rank, np.zeros(2 * reach, np.int64)]
        at = order[open_slots]
        key = (padded[at] << 42) | (padded[at + reach] << 21) | padded[at + 2 * reach]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[open_slots] = at
        new = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(new)
        rank = rank.copy()
        rank[at] = np.repeat(open_slots[start], np.diff(np.r_[start, len(at)])) + 1
        tied = np.repeat(np.diff(np.r_[start, len(at)]) > 1, np.diff(np.r_[start, len(at)]))
        open_slots = open_slots[tied]
        reach *= 3
    return order


def _bound(codes: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, wanted: np.ndarray, upper: bool):
    """First slot in [lo, hi) whose k-th code is not below (``upper``: is above) the wanted one."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        value = codes[order[mid] + k]
        go = value <= wanted[live] if upper else value < wanted[live]
        lo[live] = np.where(go, mid + 1, lo[live])
        hi[live] = np.where(go, hi[live], mid)
        live = live[lo[live] < hi[live]]
    return lo


def search(codes: np.ndarray, order: np.ndarray, wanted: np.ndarray, left: np.ndarray, window: np.ndarray):
    """For each suffix of ``wanted``: its longest match, the slots of that, and the slots of its window."""
    n, q = len(order), len(wanted)
    padded = np.r_[codes, np.full(int(left.max(initial=0)) + 1, -2)]
    lo, hi, length = np.zeros(q, np.int64), np.full(q, n), np.zeros(q, np.int64)
    window_lo, window_hi = np.zeros(q, np.int64), np.zeros(q, np.int64)
    live, k = np.arange(q), 0
    while len(live):
        sought = wanted[live + k]
        below = _bound(padded, order, lo[live], hi[live], k, sought, False)
        above = _bound(padded, order, below, hi[live], k, sought, True)
        found = below < above
        live = live[found]
        lo[live], hi[live], length[live] = below[found], above[found], k + 1
        ends = live[window[live] == k + 1]
        window_lo[ends], window_hi[ends] = lo[ends], hi[ends]
        k += 1
        live = live[left[live] > k]
    return length, lo, hi, window_lo, window_hi


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All slots of the intervals, and the interval of each."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    return lo[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes), owner


def _matches(hashes: np.ndarray, items: Items, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per shard: places and numbers of windows, then places and lengths of the longest matches that hold a window.

    Shards overlap by the longest item, so no match is lost at their ends.
    """
    step = SHARD_WORDS - reach
    for start in range(0, max(1, len(hashes) - reach), max(step, 1)):
        part = hashes[start: start + SHARD_WORDS]
        if not len(part):
            return
        known, codes = np.unique(part, return_inverse=True)
        at = np.minimum(np.searchsorted(known, items.words), len(known) - 1)
        wanted = np.where(known[at] == items.words, at, -1)
        order = suffix_array(codes, reach)
        length, lo, hi, window_lo, window_hi = search(codes, order, wanted, items.left, items.window)
        own = np.flatnonzero((items.name >= 0) & (window_lo < window_hi))
        slots, which = _spread(window_lo[own], window_hi[own])
        long = np.flatnonzero((items.window > 0) & (length >= items.window))
        far, of = _spread(lo[long], hi[long])
        yield order[slots] + start, own[which], order[far] + start, length[long][of]


def _scanner(items: Items):
    reach = int(items.left.max(initial=1)) + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hashes, _, _, first = token_hashes(part.column("text"), PLAIN_WORDS)
                sizes = np.diff(first)
                # A 0 ends every document, so no match runs from one into the next.
                line = np.zeros(len(hashes) + len(sizes), np.uint64)
                starts = first[:-1] + np.arange(len(sizes))
                owner = np.repeat(np.arange(len(sizes)), sizes)
                line[np.arange(len(hashes)) + owner] = hashes
                delta = np.zeros(len(line) + 1, np.int64)
                holders: dict[int, set] = {}
                longest = np.zeros(len(sizes), np.int64)
                for place, at, far, length in _matches(line, items, reach):
                    pairs = np.unique(np.stack([place, at]), axis=1)
                    np.add.at(delta, pairs[0], 1)
                    np.add.at(delta, pairs[0] + items.window[pairs[1]], -1)
                    doc = np.searchsorted(starts, pairs[0], side="right") - 1
                    for row, name in np.unique(np.stack([doc, items.name[pairs[1]]]), axis=1).T.tolist():
                        holders.setdefault(row, set()).update(items.holders[name])
                    np.maximum.at(longest, np.searchsorted(starts, far, side="right") - 1, length)
                yield _merged(part, sizes, starts, np.cumsum(delta)[:-1] > 0, holders, longest)

    return scan


def _merged(part, sizes, starts, hit, holders, longest) -> pa.RecordBatch:
    """The slice with this block's findings added to those of the blocks before."""
    items, spans, n_hit, best = [], [], [], []
    old = [part.column(c).to_pylist() for c in ("items", "spans", "longest_match")]
    for row, size in enumerate(sizes.tolist()):
        own = hit[starts[row]: starts[row] + size]
        before_items, before_spans, before = (c[row] for c in old)
        if before_spans:
            own = own.copy()
            for a, b in zip(before_spans[::2], before_spans[1::2]):
                own[a:b] = True
        edges = np.flatnonzero(np.diff(np.r_[False, own, False])) if own.any() else np.zeros(0, np.int64)
        spans.append(edges.tolist())
        n_hit.append(int(own.sum()))
        named = holders.get(row, set()).union(before_items or ())
        items.append(sorted(named, key=lambda i: (i is None, i)))
        best.append(max(int(longest[row]), before or 0))
    made = {
        "n_words": pa.array(sizes.astype(np.int64)), "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(i) for i in items], pa.int64()), "items": pa.array(items, pa.list_(pa.string())),
        "longest_match": pa.array(best, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64())),
    }
    names = part.schema.names
    return pa.RecordBatch.from_arrays([made.get(n, part.column(i)) for i, n in enumerate(names)], names)


def scan(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with, per row: n_words, n_hit (words inside a window), n_items and items (ids with a window there),
    longest_match (words) and spans (first and last word, exclusive, of every hit stretch, one after the other).
    """
    none = {
        "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"),
        "items": F.array().cast("array<string>"), "longest_match": F.lit(0).cast("long"), "spans": F.array().cast("array<long>"),
    }
    names = [c for c in docs.columns if c.lower() not in (*OUTPUT, "text")]
    out = docs.select(F.col("text").cast("string").alias("text"), folded(names), *[c.alias(n) for n, c in none.items()])
    texts = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    for block in range(blocks):
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("text", "id").toArrow()
        items = read_items(own.column("text").to_pylist(), own.column("id").to_pylist(), width)
        out = in_workers(out, _scanner(items), out.schema)
    return unfolded(out, ["text", *names], *OUTPUT)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """The documents without any window of the benchmark."""
    return scan(docs, benchmark, width).where("n_hit = 0").drop(*OUTPUT)
