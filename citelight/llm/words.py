"""Words that a worker process has met, with their token ids.

Words and ids lie in Arrow arrays, which take a fifth of the memory of Python's own objects, so more words are remembered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Closing marks that are tokens of their own after a word.
MARKS = ".,;:!?"
#: Letters of the Latin blocks, which are letters in every version of Unicode.
LATIN = r"A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"


def packed(sizes: Iterable[int], data) -> pa.Array:
    """Consecutive pieces of ``data`` (bytes), of ``sizes`` bytes each."""
    ends = np.cumsum(np.fromiter(sizes, np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.r_[0, ends]), pa.py_buffer(data)])


def cut_marks(words: pa.Array, plain: str) -> tuple[pa.Array, pa.Array]:
    """Words whose front matches ``plain`` without their closing marks, others as they are; and the marks."""
    front = pc.utf8_rtrim(words, MARKS)
    easy = pc.match_substring_regex(front, plain)
    key = pc.if_else(easy, front, words)
    # Marks are single bytes.
    sizes = pc.binary_length(key).to_numpy()
    tails = [b""] * len(words)
    marked = np.flatnonzero(pc.binary_length(words).to_numpy() > sizes)
    for k, word in zip(marked.tolist(), words.take(pa.array(marked)).cast(pa.binary()).to_pylist()):
        tails[k] = word[sizes[k]:]
    return key, pa.array(tails, pa.binary())


class Known:
    """Distinct words and their ids."""

    def __init__(self, words: pa.Array | None = None, ids: pa.Array | None = None):
        self.words = pa.array([], pa.string()) if words is None else words
        self.ids = pa.array([], pa.large_binary()) if ids is None else ids

    def __len__(self) -> int:
        return len(self.words)

    def __contains__(self, word: str | bytes) -> bool:
        return pa.scalar(word.decode() if isinstance(word, bytes) else word) in self.words


class Remembered:
    """Ids of words in two sets: a full younger one becomes the older, which is forgotten.

    Words found in the older one move to the younger, so frequent words stay.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.young, self.old = Known(), Known()

    def __len__(self) -> int:
        return len(self.young)

    def ids(self, words: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """Ids of distinct ``words`` as bytes; ``encode`` gives those of words that were not met."""
        at = pc.index_in(words, value_set=self.young.words)
        other = words.filter(pc.is_null(at))
        before = pc.index_in(other, value_set=self.old.words)
        again, new = other.filter(pc.is_valid(before)), other.filter(pc.is_null(before))
        ids = pa.concat_arrays([self.young.ids, self.old.ids.take(before.drop_null()), encode(new)])
        # Words met lately, then those met before them, then new ones.
        places = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        last = np.where(pc.is_valid(before).to_numpy(zero_copy_only=False), 0, 1)
        order = np.empty(len(other), np.int64)
        order[np.argsort(last, kind="stable")] = len(self.young) + np.arange(len(other))
        places[places < 0] = order
        found = ids.take(pa.array(places))
        if len(ids) > self.limit:
            self.old, self.young = self.young, Known(words, found)
        else:
            self.young = Known(pa.concat_arrays([self.young.words, again, new]), ids)
        return found


def joined(ids: pa.Array, codes: pa.Array, lengths: np.ndarray) -> list[bytes]:
    """Ids of texts: ``codes`` names the ids of each word (null: none), ``lengths`` the words of each text."""
    taken = ids.take(codes)
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset: taken.offset + len(taken) + 1]
    data = taken.buffers()[2]
    cuts = ends[np.r_[0, np.cumsum(lengths)]].tolist()
    return [data[a:b].to_pybytes() for a, b in zip(cuts, cuts[1:])] if data is not None else [b""] * len(lengths)
