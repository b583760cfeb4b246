"""Packing tokenised documents into few sequences of bounded length.

Texts become ids in tasks and are cut into pieces of at most ``capacity`` ids. The pieces' lengths (no ids)
are dealt evenly to groups of about ``GROUP_PIECES``, whatever documents they come from, and each group is
packed on its own by bin completion:

* Only the largest piece left is branched on: its sequence is filled in all undominated ways. Of fillings that use
  the same space the one of larger pieces comes first; a filling is dominated if another has a larger piece where
  this one has one or more smaller pieces that fit into its place.
* The space all sequences together may waste is that of the best packing known less one sequence, minus what
  the pieces take. A filling that wastes more than is left of it is pruned, and so is a node whose pieces need too many
  sequences by the bound on halves (:func:`lower_bound`).
* Best fit in descending order packs all pieces at the root, and again what is left at every node
  that is a multiple of ``REFIT`` deep; the best of these packings is the incumbent.
* The search ends when the incumbent meets the lower bound or after ``NODES`` nodes, then with the incumbent.

A group of thousands of pieces nearly always meets its bound, so the groups lose less than one
sequence each. The emptiest sequence of every group is therefore opened again and its pieces are packed with those of the
other groups, until one group is left.

Rows: a null or empty text has the end id alone. Rows that repeat an id, or have none, are packed one by one. Pieces
of equal length are interchangeable, and settled by their place in the staged pieces. Other columns of documents
are ignored; :func:`pack` carries all columns but those named ``sequence_id`` or ``offset``. An empty table gives none.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import staged
from .token_files import _LETTERS, SPELT
from .tokens import bounded, slices
from .words import Known, Remembered, cut_marks, joined, packed

CAPACITY = 2048
END_ID = 0
#: Pieces that one task packs.
GROUP_PIECES = 50_000
#: Nodes of a group's search, and the depth after which what is left is fitted anew.
NODES = 20_000
REFIT = 64
#: Fillings of one sequence that are looked at, and steps of looking for them.
FILLINGS = 8
STEPS = 2_000
#: Words whose letters stay below U+0180 in lower case; capital A-Z are small before.
_PLAIN = r"^[a-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+$"
#: Text whose distinct words are looked up together.
SLICE_BYTES = 4 << 20
#: Words remembered by a process: those met lately, and those met before them.
REMEMBERED = 100_000


# --- ids ----------------------------------------------------------------------------------

class WordEncoder:
    """Ids of texts, for tokenizers that drop white space and never join what it parts.

    Texts are cut at ASCII spaces, the distinct words of a slice are looked up, and their ids put together
    by position. A word without its closing marks is encoded once and remembered (see :class:`.words.Remembered`).
    Whether a tokenizer parts words is read from its file; others get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as stream:
            self.parts = _parts_words(json.load(stream))
        self.words = Remembered(REMEMBERED)
        self.marks: dict[bytes, bytes] = {}

    @property
    def young(self) -> Known:
        return self.words.young

    @property
    def old(self) -> Known:
        return self.words.old

    def _mark(self, marks: bytes) -> bytes:
        """Ids of closing marks; only short ones are remembered, which are few."""
        if marks not in self.marks:
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(marks.decode())]).tobytes() if marks else b""
            if len(marks) > 3:
                return ids
            self.marks[marks] = ids
        return self.marks[marks]

    def _new(self, words: pa.Array) -> pa.Array:
        """Ids of words: letters by the vocabulary's model, others side by side in one text or one by one."""
        plain = pc.match_substring_regex(words, _PLAIN)
        ascii_only = pc.and_not(pc.string_is_ascii(words), plain)
        other = pc.invert(pc.or_(plain, ascii_only))
        made, places, at = [], np.empty(len(words), np.int64), 0
        for chosen, encode in ((plain, self._letters), (ascii_only, self._side_by_side), (other, self._one_by_one)):
            made.append(encode(words.filter(chosen)))
            places[chosen.to_numpy(zero_copy_only=False)] = at + np.arange(len(made[-1]))
            at += len(made[-1])
        return pa.concat_arrays(made).take(pa.array(places))

    def _letters(self, words: pa.Array) -> pa.Array:
        """Latin letters are letters in every version of Unicode and never join with each other."""
        if not len(words):
            return pa.array([], pa.large_binary())
        order = pc.array_sort_indices(words)  # similar words follow each other
        text = "\0".join(words.take(order).to_pylist()).lower()
        spelt = SPELT[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        tokenize = self.tokenizer.model.tokenize
        rows = [[t.id for t in tokenize(word)] for word in spelt.split(_LETTERS[0])]
        back = np.empty(len(rows), np.int64)
        back[order.to_numpy()] = np.arange(len(rows))
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return packed(4 * sizes, array("I", chain.from_iterable(rows))).take(pa.array(back))

    def _side_by_side(self, words: pa.Array) -> pa.Array:
        if not len(words):
            return pa.array([], pa.large_binary())
        texts = words.to_pylist()
        made = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        begins = np.cumsum([0, *(len(text) + 1 for text in texts)])
        cuts = np.searchsorted(np.array([o[0] for o in made.offsets], np.int64), begins)
        return packed(4 * np.diff(cuts), array("I", made.ids))

    def _one_by_one(self, words: pa.Array) -> pa.Array:
        made = self.tokenizer.encode_batch(words.to_pylist(), add_special_tokens=False)
        return pa.array([array("I", one.ids).tobytes() for one in made], pa.large_binary())

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        if not self.parts:
            made = self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in made]
        # The tokenizer reads capitals as small letters, so a word is looked up in one form.
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
        coded = split.flatten().dictionary_encode()
        words, marks = cut_marks(coded.dictionary, _PLAIN)
        words, marks = words.dictionary_encode(), marks.dictionary_encode()
        own = self.words.ids(words.dictionary, self._new).take(words.indices)
        after = pa.array(map(self._mark, marks.dictionary.to_pylist()), pa.large_binary()).take(marks.indices)
        whole = pc.binary_join_element_wise(own, after, pa.scalar(b"", pa.large_binary()))
        return joined(whole, coded.indices, split.value_lengths().to_numpy())


def _parts_words(form: dict) -> bool:
    """Whether ids of a text are those of its words between ASCII spaces, one after the other.

    So it is if normalisers look at neighbouring letters at most, the text is split by a pattern whose matches
    hold no white space and part letters from marks, its bytes are spelt as letters, nothing is put around the
    ids, and no added token holds or takes white space.
    """
    def steps(part: dict | None, key: str) -> list[dict]:
        return [] if part is None else part[key] if part["type"] == "Sequence" else [part]

    normal = steps(form.get("normalizer"), "normalizers")
    cut = steps(form.get("pre_tokenizer"), "pretokenizers")
    if not any(step["type"] == "Lowercase" for step in normal):
        return False
    fine = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
    for step in normal:
        spaces = step["type"] == "Replace" and step.get("pattern") == {"Regex": r"\s+"} and step.get("content") == " "
        if step["type"] not in fine and not spaces:
            return False
    if not cut or cut[0]["type"] != "Split" or not cut[0].get("invert") or cut[0].get("behavior") != "Removed":
        return False
    pattern = cut[0]["pattern"].get("Regex", " ")
    if pattern != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
        return False
    if [step["type"] for step in cut[1:]] != ["ByteLevel"] or cut[1].get("add_prefix_space") or cut[1].get("use_regex"):
        return False
    spaced = (t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in form.get("added_tokens", []))
    return not any(spaced) and not form.get("truncation") and not form.get("padding")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this process, which remembers words from one task to the next."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): doc_id, piece, start, length, ids (little-endian 32-bit, the end id last)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows, pieces, made = [], [], []
                for row, ids in enumerate(encoder.ids(part.column("text"))):
                    ids += end
                    for at in range(0, len(ids), 4 * capacity):
                        rows.append(row)
                        pieces.append(at // (4 * capacity))
                        made.append(ids[at: at + 4 * capacity])
                number = np.array(pieces, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(number.astype(np.int32)),
                        pa.array(number * capacity), pa.array([len(ids) // 4 for ids in made], pa.int64()), pa.array(made, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return bounded(rows).mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids binary")


# --- packing ------------------------------------------------------------------------------


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that pieces need at least; ``counts[n]`` is the number of pieces of ``n`` ids.

    For every k up to half the capacity: pieces longer than ``capacity - k`` stand alone, those over half each take a
    sequence of their own, and what they leave must hold the other pieces of at least k ids.
    """
    sizes = np.arange(capacity + 1)
    number = np.r_[0, np.cumsum(counts)]
    mass = np.r_[0, np.cumsum(counts * sizes)]
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k + 1]
    # Pieces longer than half the capacity, but not alone.
    large = number[capacity - k + 1] - number[half + 1]
    large_mass = mass[capacity - k + 1] - mass[half + 1]
    small_mass = mass[half + 1] - mass[k]
    more = np.maximum(0, small_mass - (large * capacity - large_mass))
    return int((alone + large + -(-more // capacity)).max())


def best_fit(counts: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences as lists of lengths: pieces in descending order, each where it leaves the least space."""
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    open_rooms, made = 0, []
    for size in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[size])):
            wide = open_rooms >> size
            if wide:
                left = size + ((wide & -wide).bit_length() - 1)
                sequence = room[left].pop()
                if not room[left]:
                    open_rooms ^= 1 << left
            else:
                left, sequence = capacity, []
                made.append(sequence)
            sequence.append(size)
            room[left - size].append(sequence)
            if left > size:
                open_rooms |= 1 << (left - size)
    return made


def _fillings(counts: np.ndarray, room: int, waste: int) -> list[tuple[int, ...]]:
    """Undominated sets of pieces that fill ``room`` but for at most ``waste``, the fullest first.

    At most ``FILLINGS``, found in at most ``STEPS`` steps from larger to smaller pieces.
    """
    sizes = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    if not sizes:
        return [()] if room <= waste else []
    if counts[room]:
        return [(room,)]  # a single piece that fills the room dominates every other set
    left = {s: int(counts[s]) for s in sizes}
    found: list[tuple[int, ...]] = []
    steps = 0
    tightest = waste

    def fill(at: int, space: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps, tightest
        steps += 1
        if steps > STEPS or len(found) >= 4 * FILLINGS:
            return
        for k in range(at, len(sizes)):
            size = sizes[k]
            if size <= space and left[size]:
                left[size] -= 1
                fill(k, space - size, (*chosen, size))
                left[size] += 1
                if steps > STEPS or (found and tightest == 0 and len(found) >= FILLINGS):
                    return
        # Closed only if no further piece fits.
        if space <= waste and not any(s <= space and left[s] for s in reversed(sizes)):
            found.append(chosen)
            tightest = min(tightest, space)

    fill(0, room, ())
    found.sort(key=lambda c: (room - sum(c), [-s for s in c]))
    kept: list[tuple[int, ...]] = []
    for chosen in found:
        if len(kept) == FILLINGS:
            break
        if chosen not in kept and not any(_dominated(chosen, other) for other in kept):
            kept.append(chosen)
    return kept


def _dominated(small: tuple[int, ...], large: tuple[int, ...]) -> bool:
    """Whether the pieces of ``small`` fit into the places that the pieces of ``large`` take."""
    rooms = list(large)

    def place(at: int) -> bool:
        if at == len(small):
            return True
        tried = set()
        for k, room in enumerate(rooms):
            if room >= small[at] and room not in tried:
                tried.add(room)
                rooms[k] -= small[at]
                if place(at + 1):
                    return True
                rooms[k] = room
        return False

    return place(0) if sum(small) <= sum(large) and max(small, default=0) <= max(large, default=0) else False


def complete_bins(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[list[int]]:
    """Sequences (lists of lengths) for the pieces in ``counts``, by branch and bound over completions."""
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    if len(best) == bound:
        return best
    counts = counts.copy()
    total = int((counts * np.arange(capacity + 1)).sum())
    made: list[list[int]] = []
    wasted = 0

    def open_node() -> list[tuple[int, ...]]:
        """Fillings of the next sequence, the best one last; none if nothing below can improve the incumbent."""
        nonlocal best
        sizes = np.flatnonzero(counts)
        if not len(sizes):
            if len(made) < len(best):
                best = [list(m) for m in made]
            return []
        if len(made) % REFIT == 0:
            rest = best_fit(counts, capacity)
            if len(made) + len(rest) < len(best):
                best = [*map(list, made), *rest]
            if len(made) + lower_bound(counts, capacity) >= len(best):
                return []
        allowed = (len(best) - 1) * capacity - total - wasted
        if allowed < 0:
            return []
        largest = int(sizes[-1])
        counts[largest] -= 1
        fillings = [(largest, *f) for f in _fillings(counts, capacity - largest, allowed)]
        counts[largest] += 1
        return fillings[::-1]

    stack = [open_node()]
    while stack and len(best) > bound and nodes:
        nodes -= 1
        if not stack[-1]:
            stack.pop()
            if made:
                undone = made.pop()
                wasted -= capacity - sum(undone)
                for size in undone:
                    counts[size] += 1
            continue
        chosen = stack[-1].pop()
        if wasted + capacity - sum(chosen) > (len(best) - 1) * capacity - total:
            continue
        for size in chosen:
            counts[size] -= 1
        made.append(list(chosen))
        wasted += capacity - sum(chosen)
        stack.append(open_node())
    return best


def assign(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of every piece of a group, and the number of the emptiest sequence."""
    sequences = complete_bins(np.bincount(lengths, minlength=capacity + 1), capacity)
    order = np.argsort(lengths, kind="stable")
    at = np.searchsorted(lengths[order], np.arange(capacity + 1)).tolist()
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for number, sizes in enumerate(sequences):
        used = 0
        for size in sizes:
            row = order[at[size]]
            at[size] += 1
            sequence[row], offset[row] = number, used
            used += size
    return sequence, offset, int(np.argmin([sum(s) for s in sequences]))


def _packer(capacity: int, turn: int, last: bool):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if len(batch)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        lengths = table.column("length").to_numpy().astype(np.int64)
        if lengths.min() < 1 or lengths.max() > capacity:
            raise ValueError(f"a piece must have 1 to {capacity} ids")
        sequence, offset, emptiest = assign(lengths, capacity)
        # Opened again, unless this is the last turn.
        again = np.zeros(len(lengths), bool) if last else sequence == emptiest
        group = TaskContext.get().partitionId()
        table = table.append_column("sequence_id", pa.array(((turn << 24 | group) << 32) + sequence))
        table = table.append_column("offset", pa.array(offset)).append_column("again", pa.array(again))
        yield from table.to_batches(max_chunksize=100_000)

    return packed


def plan(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``sequence_id`` and ``offset`` for rows of ``key`` and ``length``."""
    made = StructType([
        pieces.schema["key"], StructField("length", LongType()), *[StructField(c, LongType()) for c in ("sequence_id", "offset")],
    ])
    done, turn, left = [], 0, pieces.select("key", "length")
    while True:
        n = left.count()
        groups = max(1, -(-n // group_pieces))
        # Dealt in turn, not by a key, so that equal rows are spread; the order within a group is that of the keys.
        dealt = left.repartition(groups).sortWithinPartitions("key")
        full = StructType([*made.fields]).add("again", "boolean")
        round_made = staged(bounded(dealt).mapInArrow(_packer(capacity, turn, groups == 1), full), "packed")
        if groups == 1:
            done.append(round_made.select(*made.names))
            break
        done.append(round_made.where("NOT again").select(*made.names))
        left = round_made.where("again").select("key", "length")
        turn += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "sequence_id", "offset")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (a column ``length``, any others) with ``sequence_id`` and, in the sequence, ``offset``."""
    carried = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    rows = staged(pieces.select(
        F.monotonically_increasing_id().alias("key"), F.col("length").cast("long").alias("length"),
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
    ), "pieces")
    found = plan(rows, capacity, group_pieces)
    return rows.join(found, "key").select(*[F.col("row")[c].alias(c) for c in carried], "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids of all their pieces, and where each piece lies.

    A group holds ``capacity`` ids at most.
    """
    piece = F.struct("offset", "doc_id", "piece", "ids")
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("length").alias("length"))
    ids = F.aggregate("pieces", F.lit(b""), lambda before, p: F.concat(before, p["ids"]))
    places = F.transform("pieces", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset")))
    return held.select("sequence_id", "length", ids.alias("ids"), places.alias("pieces"))
