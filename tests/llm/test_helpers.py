"""Small pure parts against brute force."""

import random

import numpy as np
import pyarrow as pa

from citelight.llm import fuse
from citelight.llm.decontamination import read_items, suffix_array
from citelight.llm.lines import GRAM, segment_keys, sketches, within
from citelight.llm.tokens import SPACED_WORDS, shingle_hashes, token_hashes


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited_pairs(n, low, high):
    rng = random.Random(3)
    for _ in range(n):
        a = [rng.choice(b"abc") for _ in range(rng.randint(low, high))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k, what = rng.randint(0, len(b)), rng.random()
            if what < 0.33 or not b:
                b.insert(k, rng.choice(b"abc"))
            elif what < 0.66:
                b.pop(min(k, len(b) - 1))
            else:
                b[min(k, len(b) - 1)] = rng.choice(b"abc")
        yield bytes(a), bytes(b)


def test_banded_distance_segments_and_sketch():
    for edits in (1, 2, 3):
        pairs = list(edited_pairs(800, 0, 16))
        got = within([a for a, _ in pairs], [b for _, b in pairs], edits)
        for (a, b), near in zip(pairs, got):
            true = distance(a, b) <= edits
            assert near == true
            if true:
                bits = sketches([a, b]).view(np.uint64)
                assert sum(int(x ^ y).bit_count() for x, y in zip(*bits)) <= 2 * GRAM * edits
                if min(len(a), len(b)) > 2 * edits:
                    keys, owner = segment_keys([a, b], edits)
                    assert set(keys[owner == 0]) & set(keys[owner == 1])


def test_fuse_filter_misses_no_key():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        built = fuse.build(np.r_[keys, keys])
        assert fuse.may_hold(keys, *built).all()
        other = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
        assert fuse.may_hold(other, *built).mean() < 0.01


def test_token_hashes_are_words():
    texts = ["Ab ab\taB", None, "", " é\n", "ab", "a" * 70_000 + " b"]
    hashes, starts, ends, rows = token_hashes(pa.array(texts, pa.string()), SPACED_WORDS)
    assert np.diff(rows).tolist() == [3, 0, 0, 1, 1, 2]
    assert hashes[0] == hashes[1] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 4
    _, first = shingle_hashes(hashes, rows, 2)
    assert np.diff(first).tolist() == [2, 0, 0, 1, 1, 1]


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(2)
    for depth in (1, 3, 20):
        codes = rng.integers(0, 4, 300)
        order = suffix_array(codes, depth)
        cut = [tuple(codes[i: i + depth]) for i in order]
        assert cut == sorted(cut) and sorted(order) == list(range(300))


def test_items_share_windows():
    items = read_items(["a b c", "A, b. C", None, "a b c d"], ["1", "2", "3", None], 3)
    assert sorted(map(str, items.holders)) == ["['1', '2', None]", "[None]"]
