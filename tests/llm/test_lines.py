"""Which lines are sketched, and what the sketches rule out."""

import random

import numpy as np
import pyarrow as pa

from citelight.llm import lines
from test_helpers import distance, edited_pairs


def implausible(a, b, edits):
    """Whether a sketch rules out that two lines are within ``edits`` edits."""
    for gram in lines.GRAMS:
        bits = lines.sketches([a, b], gram).view(np.uint64)
        if sum(int(x ^ y).bit_count() for x, y in zip(*bits)) > 2 * gram * edits:
            return True
    return False


def test_sketches_of_no_length_rule_out_a_near_line():
    for edits in (1, 2, 3):
        for a, b in edited_pairs(500, 0, 16):
            assert distance(a, b) > edits or not implausible(a, b, edits)


def test_short_substrings_tell_edited_copies_apart():
    """Copies with other letters put in at two places each are mostly told apart, which four-byte substrings alone do not."""
    rng = random.Random(7)
    base = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(500))

    def copy():
        out = bytearray(base)
        for _ in range(2):
            at = rng.randrange(len(out))
            out[at:at] = bytes(rng.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(3))
        return bytes(out)

    copies = list({copy() for _ in range(60)})
    left = [not implausible(a, b, 2) for i, a in enumerate(copies) for b in copies[:i]]
    long_only = [
        int(np.bitwise_count(np.bitwise_xor(*lines.sketches([a, b]).view(np.uint64))).sum()) <= 16
        for i, a in enumerate(copies) for b in copies[:i]
    ]
    assert sum(left) * 2 < sum(long_only)


def test_only_lines_that_share_a_key_are_sketched(docs_of, monkeypatch):
    docs = docs_of(*[(k, f"{'abcdefgh'[k] * 40} of its own\nand a line that all of them hold, long enough{'.' * (k % 2)}") for k in range(8)])
    held = []
    through = lines.link_through

    def seen(keys, load, *more):
        def loaded(wanted):
            found = load(wanted)
            held.append((found.columns, found.count(), wanted.count()))
            return found

        return through(keys, loaded, *more)

    monkeypatch.setattr(lines, "link_through", seen)
    assert [sorted(r) for r in lines.duplicate_lines(docs).select("removed").collect()] == [[[1]]] * 7
    assert held == [(["node", "text", *lines.SKETCH], 2, 2)]
    part = pa.RecordBatch.from_pydict({"text": pa.array([b"x" * 40], pa.binary())})
    assert next(lines._texts(32)(iter([part]))).schema.names == ["node", "text"]  # not sketched yet


def test_pairs_that_sketches_rule_out_are_not_compared(docs_of, monkeypatch):
    start = "the same long beginning of every line, which gives them a common segment, "
    own = ["".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=60)) for k in range(6)]
    docs = docs_of(*[(k, start + end) for k, end in enumerate(own)], (6, start + own[0][:-1]))
    compared = []
    bounded = lines.bounded

    def seen(rows):
        if "text_a" in rows.columns:
            compared.append(rows.count())
        return bounded(rows)

    monkeypatch.setattr(lines, "bounded", seen)
    assert [(r["doc_id"], r["removed"]) for r in lines.duplicate_lines(docs).collect()] == [(6, [0])]
    assert sum(compared) == 1
