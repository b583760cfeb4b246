"""WARC archives written and read as streams of payload chunks.

A payload is never handled as one block of an archive: it is a run of rows (record, chunk number,
bytes) of at most ``CHUNK_BYTES``, and every row carries the SHA-256 of the payload up to its end.
The writer turns such rows into gzip members, one per record; the reader turns archives back into
the same rows. Both hold one chunk and one compression window, whatever a record's size.

Records with equal payloads of at least ``REVISIT_BYTES`` are stored once: that of the smallest page_id
is the response, the others are revisit records that name it.

Rows: a null html is an empty payload, always a response. A null url is left out; control characters in a
url are percent-encoded. Pages without page_id count as the largest; if no equal page has an
id, all are responses. Pages that repeat the id and the payload of a response are responses themselves.
Other columns are ignored whatever their names. An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path, staged
from .files import new_file, open_at
from .tokens import bounded, slices

CHUNK_BYTES = 1 << 18
REVISIT_BYTES = 100
#: An archive is closed once it holds this much, and a reader takes about this much at a time.
FILE_BYTES = 256 << 20
RANGE_BYTES = 32 << 20
#: Tasks that read ranges at most at a time, each one range after the other.
READERS = 10_000
DATE = "2000-01-01T00:00:00Z"

CHUNK_ROWS = (
    "page_id string, record_type string, url string, refers_to string, chunk int, payload binary, payload_end long,"
    " digest_so_far string, last boolean"
)


def chunks_of(payload: bytes) -> Iterator[tuple[int, memoryview, int, str, bool]]:
    """(number, bytes, end, SHA-256 up to the end, last) of a payload; an empty one has one empty chunk."""
    seen, view, at = hashlib.sha256(), memoryview(payload), 0
    for number in range(max(1, -(-len(payload) // CHUNK_BYTES))):
        part = view[at: at + CHUNK_BYTES]
        at += len(part)
        seen.update(part)
        yield number, part, at, seen.copy().hexdigest(), at == len(payload)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            ends = [list(chunks_of(p or b""))[-1] for p in part.column("html").to_pylist()]
            digests = pa.array([e[3] for e in ends], pa.string())
            sizes = pa.array([e[2] for e in ends], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, sizes, digests], [*part.schema.names, "payload_bytes", "payload_digest"])


def _payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, html (bytes) with payload_bytes and payload_digest."""
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html"))
    return bounded(rows).mapInArrow(_measured, f"page_id {kind}, url string, html binary, payload_bytes long, payload_digest string")


def _head(fields: dict[str, str | None]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _safe(url: str | None) -> str | None:
    return url and "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _urn(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _writer(folder: str, file_bytes: int, range_bytes: int):
    def member(pieces) -> Iterator[bytes]:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        for piece in pieces:
            yield pack.compress(piece)
        yield pack.flush()

    def record(row: dict) -> Iterator[bytes]:
        page, refers = row["page_id"], row["refers_to"]
        fields = {
            "WARC-Type": "response" if refers is None else "revisit", "WARC-Record-ID": _urn(page, row["payload_digest"]),
            "WARC-Date": DATE, "WARC-Target-URI": _safe(row["url"]), "Content-Type": "application/http; msgtype=response",
            "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
            "X-Page-ID": None if page is None else str(page), "X-Payload-Length": str(row["payload_bytes"]),
        }
        if refers is not None:
            fields |= {
                "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                "WARC-Refers-To": _urn(refers, row["payload_digest"]), "X-Refers-To-Page-ID": str(refers),
            }
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
        stored = row["payload_bytes"] if refers is None else 0
        yield _head(fields | {"Content-Length": str(len(http) + stored)})
        yield http
        if refers is None:
            for _, part, _, _, _ in chunks_of(row["html"] or b""):
                yield part
        yield b"\r\n\r\n"

    def one_file(rows: Iterator[dict]) -> list[dict]:
        ranges = []
        with new_file(folder, ".warc.gz") as (name, out):
            at = held = 0
            info = b"software: citelight\r\n"
            fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": _urn(name), "WARC-Date": DATE}
            first = [_head(fields | {"Content-Type": "application/warc-fields", "Content-Length": str(len(info))}), info, b"\r\n\r\n"]
            for piece in member(first):
                out.write(piece)
                at += len(piece)
            start = at
            for row in rows:
                for piece in member(record(row)):
                    out.write(piece)
                    at += len(piece)
                held += 1
                if at - start >= range_bytes:
                    ranges.append({"name": name, "start": start, "end": at, "records": held})
                    start, held = at, 0
                if at >= file_bytes:
                    break
            if held:
                ranges.append({"name": name, "start": start, "end": at, "records": held})
        return ranges

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = written = 0

        def rows():
            nonlocal given
            for batch in batches:
                given += batch.num_rows
                for part in slices(batch, "html"):
                    for i in range(part.num_rows):
                        yield {c: part.column(c)[i].as_py() for c in part.schema.names}

        stream = rows()
        for first in stream:
            # A chain, unlike a generator that delegates, leaves the stream open when an archive ends before it.
            ranges = one_file(chain([first], stream))
            written += sum(r["records"] for r in ranges)
            yield pa.RecordBatch.from_pylist(ranges)
        given += sum(batch.num_rows for batch in batches)
        if given != written:
            raise ValueError(f"{written} of {given} pages are in the archives")

    return write


def write(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES):
    """Write ``pages`` (page_id, url, html); returns the folder and the list of byte ranges to read (name, start, end, records)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = _payloads(pages)
    same = (
        rows.select("page_id", "payload_bytes", "payload_digest").where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    same = staged(same, "same")
    refers = F.when(F.col("first_id").eqNullSafe(F.col("page_id")), F.lit(None)).otherwise(F.col("first_id"))
    rows = rows.join(same, "payload_digest", "left").withColumn("refers_to", refers).drop("first_id")
    kept = F.when(F.col("refers_to").isNull(), F.col("html"))
    rows = rows.select(
        F.col("page_id").cast("string").alias("page_id"), "url", kept.alias("html"), "payload_bytes", "payload_digest",
        F.col("refers_to").cast("string").alias("refers_to"),
    )
    ranges = bounded(rows).mapInArrow(_writer(folder, file_bytes, range_bytes), "name string, start long, end long, records long")
    return folder, staged(ranges, "ranges")


class _Records:
    """Records of a stretch of an archive, read block by block."""

    def __init__(self, stream, length: int):
        self.stream, self.left, self.held, self.unpack, self.raw = stream, length, b"", None, b""

    def _more(self) -> bool:
        """Decompress one more block into ``held``; False at the end."""
        while True:
            if not self.raw:
                block = self.stream.read(min(CHUNK_BYTES, self.left)) if self.left else b""
                self.left -= len(block)
                self.raw = bytes(block)
            if not self.raw:
                return False
            if self.unpack is None:
                self.unpack = zlib.decompressobj(31)
            got = self.unpack.decompress(self.raw, CHUNK_BYTES)
            if self.unpack.eof:
                self.raw, self.unpack = self.unpack.unused_data, None
            else:
                self.raw = self.unpack.unconsumed_tail
            if got:
                self.held += got
                return True

    def head(self) -> list[str] | None:
        while b"\r\n\r\n" not in self.held:
            if not self._more():
                if self.held:
                    raise ValueError("an archive ends inside a record")
                return None
        lines, _, self.held = self.held.partition(b"\r\n\r\n")
        return lines.decode().split("\r\n")

    def body(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.held and not self._more():
                raise ValueError("an archive ends inside a record")
            part, self.held = self.held[: min(length, CHUNK_BYTES)], self.held[min(length, CHUNK_BYTES):]
            length -= len(part)
            yield part


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def read_records(stream, length: int) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """(header fields, payload blocks) of every record; the blocks must be used up before the next record."""
    records = _Records(stream, length)
    while (lines := records.head()) is not None:
        fields = _fields(lines)
        left = int(fields["content-length"])
        if fields["content-type"].startswith("application/http"):
            left -= sum(len(line.encode()) + 2 for line in records.head()) + 2
        yield fields, records.body(left)
        if b"".join(records.body(4)) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")


def _reader(folder: str, payload: bool):
    def rechunk(blocks: Iterator[bytes]) -> Iterator[tuple[int, bytes, int, str, bool]]:
        seen, held, at, number = hashlib.sha256(), b"", 0, 0
        for block in blocks:
            held += block
            while len(held) > CHUNK_BYTES:
                part, held = held[:CHUNK_BYTES], held[CHUNK_BYTES:]
                seen.update(part)
                at += len(part)
                yield number, part, at, seen.copy().hexdigest(), False
                number += 1
        seen.update(held)
        yield number, held, at + len(held), seen.hexdigest(), True

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CHUNK_ROWS.split(",")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                with open_at(folder, row["name"], row["start"]) as stream:
                    for fields, blocks in read_records(stream, row["end"] - row["start"]):
                        about = (
                            fields.get("x-page-id"), fields["warc-type"], fields.get("warc-target-uri"), fields.get("x-refers-to-page-id"),
                        )
                        if fields["warc-type"] == "revisit":
                            size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].partition(":")[2]
                            rows.append((*about, 0, None, size, digest, True))
                        else:
                            for number, part, end, digest, last in rechunk(blocks):
                                rows.append((*about, number, part if payload else None, end, digest, last))
                                held += len(part) * payload
                                if last and f"sha256:{digest}" != fields["warc-payload-digest"]:
                                    raise ValueError(f"record {fields['warc-record-id']} is damaged")
                                if held >= 4 << 20 or len(rows) >= 10_000:
                                    yield batch_of(rows)
                                    rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return read


def read(folder: str, ranges: DataFrame, payload: bool = True) -> DataFrame:
    """The archives as chunk rows: page_id, record_type, url, refers_to, chunk, payload, payload_end, digest_so_far, last.

    Digests are computed from the bytes read and compared with the header. Without ``payload`` the bytes are
    checked and left out. A revisit record is one row with the size and digest of the payload it stands for.
    """
    # A number is given so that the few rows of the list are not gathered in one task.
    spread = ranges.select("name", "start", "end").repartition(min(max(ranges.count(), 1), READERS))
    return spread.mapInArrow(_reader(folder, payload), CHUNK_ROWS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    kind = pages.schema["page_id"].dataType
    return read(*write(pages), payload=False).where("last").select(
        F.col("page_id").cast(kind).alias("page_id"), F.col("payload_end").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )
