"""Token ids in files, every document compressed on its own with a shared dictionary.

A zstandard dictionary is trained on serialised id arrays. The documents are range-partitioned by id; a
task encodes its documents in order and appends one compressed frame each to a file:

    header  magic, length and SHA-256 of the dictionary
    frames  one zstandard frame per document: its ids as little-endian unsigned 32-bit integers
    index   per document the end of its frame and its number of ids, 64-bit each
    footer  number of documents, place of the index, magic

A file names the dictionary it needs by hash; the dictionary lies beside the files under that
name. With the index any single document is read with two small reads.

Words that a process has met are not encoded again (see :class:`Encoder`).

Rows: a null or empty text has the end id alone. Rows without doc_id come first. Rows that repeat an
id follow each other, ordered by text; equal rows are interchangeable. Other columns are ignored whatever their names. An
empty table gives no file and an empty result.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path, staged
from .files import new_file, open_at
from .tokens import in_workers, keep, slices
from .words import LATIN, Remembered, cut_marks, joined, packed

MAGIC = b"TOKFILE1"
END_ID = 0
#: Documents, and ids of each, that the dictionary is trained on; and its size.
SAMPLE_ROWS = 1000
SAMPLE_IDS = 2048
DICTIONARY_BYTES = 64 << 10
#: A file is closed once it holds this much.
FILE_BYTES = 256 << 20
#: Tasks that read files at most at a time, each one file after the other.
READERS = 10_000
#: Letters of a text that may bound a range of rows with equal ids; the rows are sorted by whole texts.
RANGE_LETTERS = 64
#: Words that a process remembers in each of its two sets.
REMEMBERED = 100_000
#: Text whose distinct words are looked up together.
SLICE_BYTES = 4 << 20

_HEADER = "<8sI32s"
_FOOTER = "<QQ8s"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if visible, else the next from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_FEED = _LETTERS[10]
#: The same letters by byte, as code points.
SPELT = np.array([ord(_LETTERS[b]) for b in range(256)], "<u4")
#: Words that the vocabulary's model takes as they are spelt, after a line feed or not.
_PLAIN = rf"^\n?[{LATIN}]+$"


#: Texts that are encoded whole: special tokens, and white space other than single spaces and line feeds between words.
_ODD = (
    r"<\||^$|^[ \n]|[ \n]$|[ \n][ \n]|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def _cuts_like_bytes(form: dict) -> bool:
    """Whether a tokenizer file splits as :class:`Encoder` does: byte-level with its own pattern and nothing before or around it."""
    cut = form.get("pre_tokenizer") or {}
    return (
        cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        and form.get("normalizer") is None and form["model"].get("type") == "BPE"
        and not form["model"].get("end_of_word_suffix") and not form["model"].get("continuing_subword_prefix")
        and all("<|" in t["content"] for t in form.get("added_tokens", []))
        and not form.get("truncation") and not form.get("padding")
    )


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The vocabulary's splitting cuts a text before a single space or line feed between other
    characters, after such a line feed, and between letters and closing marks; what lies between
    is encoded once and remembered (see :class:`.words.Remembered`), whatever marks close it. The distinct words of a
    slice are looked up once and their ids put together by position. Other texts and words go to the tokenizer
    as they are, and so do all texts of a tokenizer that splits otherwise.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as stream:
            self.fast = _cuts_like_bytes(json.load(stream))
        self.words = Remembered(REMEMBERED)
        self.marks: dict[bytes, bytes] = {}
        self.feed = [t.id for t in self.tokenizer.model.tokenize(_FEED)] if self.fast else []

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _core(self, letters: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _mark(self, marks: bytes) -> bytes:
        """Ids of closing marks; only short ones are remembered, which are few."""
        if len(marks) > 3:
            return self._core(marks.decode())
        if marks not in self.marks:
            self.marks[marks] = self._core(marks.decode())
        return self.marks[marks]

    def _new(self, words: pa.Array) -> pa.Array:
        """Ids of words, each after a space or, if it begins with one, after a line feed."""
        plain = pc.match_substring_regex(words, _PLAIN)
        fed = pc.starts_with(words, "\n")
        spaced = pc.if_else(fed, words, pc.binary_join_element_wise(pa.scalar(""), words, pa.scalar(" ")))
        made = []
        for chosen, encode in ((plain, self._plain), (pc.invert(plain), self._odd)):
            made.append(encode(spaced.filter(chosen)))
        places = np.empty(len(words), np.int64)
        of_plain = plain.to_numpy(zero_copy_only=False)
        places[of_plain] = np.arange(of_plain.sum())
        places[~of_plain] = np.arange(of_plain.sum(), len(words))
        return pa.concat_arrays(made).take(pa.array(places))

    def _plain(self, words: pa.Array) -> pa.Array:
        """Ids of letters after a space or line feed, by the vocabulary's model."""
        order = pc.array_sort_indices(words)  # similar words follow each other
        letters = SPELT[np.frombuffer("\0".join(words.take(order).to_pylist()).encode(), np.uint8)]
        tokenize, feed = self.tokenizer.model.tokenize, self.feed
        rows = [
            [t.id for t in tokenize(word)] if word[0] != _FEED else feed + [t.id for t in tokenize(word[1:])]
            for word in (letters.tobytes().decode("utf-32-le").split(_LETTERS[0]) if len(words) else [])
        ]
        back = np.empty(len(rows), np.int64)
        back[order.to_numpy()] = np.arange(len(rows))
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return packed(4 * sizes, array("I", chain.from_iterable(rows))).take(pa.array(back))

    def _odd(self, words: pa.Array) -> pa.Array:
        return pa.array(map(self.whole, words.to_pylist()), pa.large_binary())

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of a slice; none for a null text."""
        texts = texts.fill_null("")
        if not self.fast:
            return [self.whole(t) for t in texts.to_pylist()]
        odd = pc.match_substring_regex(texts, _ODD)
        split = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        words, marks = cut_marks(coded.dictionary, _PLAIN)
        words, marks = words.dictionary_encode(), marks.dictionary_encode()
        own = self.words.ids(words.dictionary, self._new).take(words.indices)
        after = pa.array(map(self._mark, marks.dictionary.to_pylist()), pa.large_binary()).take(marks.indices)
        lengths = split.value_lengths().to_numpy()
        first = np.zeros(len(coded), bool)
        first[np.cumsum(lengths) - lengths] = True  # a text's first word follows nothing
        codes = pc.if_else(pa.array(first), pa.scalar(None, pa.int32()), coded.indices)
        opening = iter(pc.list_element(split, 0).to_pylist())
        pieces = iter(joined(pc.binary_join_element_wise(own, after, pa.scalar(b"", pa.large_binary())), codes, lengths))
        return [
            self.whole(text) if whole else self.whole(next(opening)) + next(pieces)
            for text, whole in zip(texts.to_pylist(), odd.to_pylist())
        ]

    def ids(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0]


def encoder_of(path: str) -> Encoder:
    """The encoder of this process, which remembers words from one task to the next."""
    return keep(f"token_files {path}", lambda: Encoder(path))


def _end(ids: bytes) -> bytes:
    return ids + struct.pack("<I", END_ID)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from at most ``SAMPLE_ROWS`` documents, ``SAMPLE_IDS`` ids of each; empty if there is too little."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("length(text) > 0")
    keyed = texts.withColumn("_key", F.xxhash64("text"))
    keys = keyed.select("_key").distinct().orderBy("_key").limit(SAMPLE_ROWS)
    chosen = keyed.join(F.broadcast(keys), "_key", "left_semi").dropDuplicates(["_key"]).select("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in batches:
            made = [_end(ids)[: 4 * SAMPLE_IDS] for ids in encoder.batch(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["ids"])

    samples = sorted(bytes(r[0]) for r in in_workers(chosen, encode, "ids binary", f"token_files {tokenizer}").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples to learn from
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _writer(folder: str, tokenizer: str, dictionary: bytes, file_bytes: int):
    def one_file(rows, compressor, rank: int):
        ends, sizes = [], []
        with new_file(folder, ".tok") as (name, out):
            out.write(struct.pack(_HEADER, MAGIC, len(dictionary), hashlib.sha256(dictionary).digest()))
            at = struct.calcsize(_HEADER)
            for part, ids in rows:
                ids = _end(ids)
                frame = compressor.compress(ids)
                out.write(frame)
                at += len(frame)
                ends.append(at)
                sizes.append(len(ids) // 4)
                if at >= file_bytes:
                    break
            out.write(np.array([ends, sizes], "<u8").T.tobytes())
            out.write(struct.pack(_FOOTER, len(ends), at, MAGIC))
        return {"piece": part, "rank": rank, "name": name, "docs": len(ends), "ids": sum(sizes)}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, compressor = encoder_of(tokenizer), _compressor(dictionary)

        def rows():
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    yield from zip(part.column("piece").to_pylist(), encoder.batch(part.column("text")))

        stream = rows()
        rank = 0
        for first in stream:
            # A chain, unlike a generator that delegates, leaves the stream open when a file ends before it.
            row = one_file(chain([first], stream), compressor, rank)
            rank += 1
            yield pa.RecordBatch.from_pylist([row])

    return write


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, file_bytes: int = FILE_BYTES):
    """Write ``docs`` (doc_id, text); returns the folder, the dictionary, the file list and the ids by position.

    Files follow each other by (piece, rank), documents within a file by their position; the last
    frame (piece, position, doc_id) names them.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    dictionary = train_dictionary(docs, tokenizer)
    system_name = f"{hashlib.sha256(dictionary).hexdigest()}.dict"
    _put(folder, system_name, dictionary)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # A sample of the keys that bound the ranges goes to the driver: a text's beginning, which is in the order of the texts.
    bounds = [order[0], F.left("text", F.lit(RANGE_LETTERS)).asc_nulls_first()]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).repartitionByRange(*bounds)
    rows = rows.sortWithinPartitions(*order).withColumn("piece", F.spark_partition_id().cast("long"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    writer = _writer(folder, tokenizer, dictionary, file_bytes)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids go by, so that the file list and the ids come from one run of the task."""
        ids: list[pa.Array] = []

        def seen():
            for batch in batches:
                ids.append(batch.column("doc_id"))
                yield batch

        files = [row for made in writer(seen()) for row in made.to_pylist()]
        ids.extend(batch.column("doc_id") for batch in batches)
        held = pa.concat_arrays(ids) if ids else None
        given, written = sum(map(len, ids)), sum(row["docs"] for row in files)
        if given != written:
            raise ValueError(f"{written} of {given} documents are in the files")
        at = 0
        for row in files:
            for start in range(0, row["docs"], 100_000):
                n = min(100_000, row["docs"] - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        held.slice(at + start, n), *(pa.array([row[c]] * n) for c in ("piece", "rank", "name")),
                        pa.array(range(start, start + n)), pa.array([row["docs"]] * n), pa.array([row["ids"]] * n),
                    ],
                    ["doc_id", "piece", "rank", "name", "position", "docs", "ids"],
                )
            at += row["docs"]

    listed = staged(in_workers(
        rows, both, f"doc_id {kind}, piece long, rank long, name string, position long, docs long, ids long",
        f"token_files {tokenizer}",
    ), "listed")
    return folder, dictionary, listed


def _put(folder: str, name: str, data: bytes) -> None:
    from .files import open_folder

    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}", compression=None) as out:
        out.write(data)


def read_index(folder: str, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the frames and numbers of ids of all documents in a file."""
    with open_at(folder, name, 0) as stream:
        stream.seek(stream.size() - struct.calcsize(_FOOTER))
        docs, at, magic = struct.unpack(_FOOTER, stream.read(struct.calcsize(_FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"{name} is not a token file")
        stream.seek(at)
        ends, sizes = np.frombuffer(stream.read(16 * docs), "<u8").reshape(docs, 2).T
    return ends.astype(np.int64), sizes.astype(np.int64)


def read_document(folder: str, name: str, position: int, dictionary: bytes) -> np.ndarray:
    """The ids of one document, by its place in the file."""
    ends, _ = read_index(folder, name)
    start = int(ends[position - 1]) if position else struct.calcsize(_HEADER)
    with open_at(folder, name, start) as stream:
        return np.frombuffer(_decompressor(dictionary).decompress(stream.read(int(ends[position]) - start)), "<u4")


def _reader(folder: str, dictionary: bytes):
    wanted = hashlib.sha256(dictionary).digest()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _decompressor(dictionary).decompress
        for batch in batches:
            for row in batch.to_pylist():
                ends, sizes = read_index(folder, row["name"])
                starts = np.cumsum(sizes) - sizes
                with open_at(folder, row["name"], 0) as stream:
                    magic, length, named = struct.unpack(_HEADER, stream.read(struct.calcsize(_HEADER)))
                    if magic != MAGIC or length != len(dictionary) or named != wanted:
                        raise ValueError(f"{row['name']} needs another dictionary")
                    at, out = struct.calcsize(_HEADER), []
                    for position, end in enumerate(ends.tolist()):
                        ids = unpack(stream.read(end - at))
                        at = end
                        out.append((position, int(starts[position]), len(ids) // 4, zlib.crc32(ids)))
                        if len(out) == 10_000:
                            yield _rows(row["name"], out)
                            out = []
                    yield _rows(row["name"], out)

    return read


def _rows(name: str, out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(out), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
        ["name", "position", "in_file", "n_tokens", "ids_crc32"],
    )


def read(folder: str, dictionary: bytes, listed: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, name, position."""
    files = staged(listed.select("name", "piece", "rank", "ids").distinct(), "files")
    earlier = Window.orderBy("piece", "rank").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    starts = files.select("name", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("_before"))
    # A file is read by one task; a number is given so that the few rows of the list are not gathered in one.
    found = files.select("name").repartition(min(max(files.count(), 1), READERS)).mapInArrow(
        _reader(folder, dictionary), "name string, position long, in_file long, n_tokens long, ids_crc32 long"
    )
    placed = found.join(starts, "name").withColumn("start", F.col("_before") + F.col("in_file"))
    return placed.join(listed.select("name", "position", "doc_id"), ["name", "position"]).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "name", "position"
    )


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids and read them back."""
    return read(*write(docs, tokenizer))
