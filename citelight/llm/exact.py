"""Exact duplicates of a batch against an immutable snapshot, screened by binary fuse filters.

A snapshot is a table of the distinct digests of its texts in hash buckets, with one
static filter per bucket. An incoming batch is first grouped by digest among itself.
Its digests pass the filters of their buckets: a digest that does not pass is new, and
the exact bucket is never read for it. What passes is joined to the exact buckets, and
the bytes of every such text are compared before it counts as a copy.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty. Rows
without doc_id are ordered before all others. Rows that repeat both id and text count
as rows of the group; those with the largest id are all kept here and told apart by
nothing, so :func:`keep_one` returns one of them. Extra columns are ignored whatever their
names. An empty snapshot, batch or table gives an empty or unscreened result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from . import fuse
from .tokens import bounded, slices

#: Digests per filter; a filter of this size takes about a megabyte.
BUCKET_ROWS = 1_000_000


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            # bytes.lower() changes A-Z only.
            made = [hashlib.sha256((b or b"").lower()).digest() for b in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "digest"])


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the SHA-256 of the normalised text of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    return bounded(rows).mapInArrow(_digest, f"doc_id {kind}, digest binary")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("last_id"), F.count("*").alias("n"))


def _bucket(buckets: int):
    # The first four bytes of a digest are as good as random.
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def build_snapshot(rows: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The exact table (bucket, digest, last_id, n) and the filters (bucket, seed, segment, span, cells)."""
    exact = staged(_grouped(rows).withColumn("bucket", _bucket(buckets)), "snapshot")

    def build(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(d[:8] for d in table.column("digest").to_pylist()), np.uint64)
        seed, segment, span, cells = fuse.build(keys)
        return pa.table({
            "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "seed": [seed],
            "segment": [segment], "span": [span], "cells": pa.array([cells], pa.binary()),
        })

    filters = exact.select("bucket", "digest").groupBy("bucket").applyInArrow(
        build, "bucket int, seed long, segment long, span long, cells binary"
    )
    return exact, staged(filters, "filters")


def screen(batch: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``batch`` (distinct digests) with ``maybe_held``: False where the snapshot certainly lacks the digest."""
    rows = batch.withColumn("bucket", _bucket(buckets))
    schema = f"digest binary, last_id {batch.schema['last_id'].dataType.simpleString()}, n long, maybe_held boolean"

    def probe(own: pa.Table, held: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(d[:8] for d in own.column("digest").to_pylist()), np.uint64)
        passed = np.zeros(len(keys), bool)
        for row in held.to_pylist():
            passed |= fuse.may_hold(keys, row["seed"], row["segment"], row["span"], row["cells"])
        return own.select(["digest", "last_id", "n"]).append_column("maybe_held", pa.array(passed))

    return rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, schema)


def _same_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The digests of ``wanted`` all of whose texts in ``docs`` agree byte by byte."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                # Copies that a task meets together leave it once, so a hot text costs one row a slice.
                plain = list({(b or b"").lower() for b in part.column("text").to_pylist()})
                made = [hashlib.sha256(b).digest() for b in plain]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made, pa.binary()), pa.array(plain, pa.binary())], ["digest", "plain"]
                )

    rows = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    rows = bounded(rows).mapInArrow(texts, "digest binary, plain binary").join(wanted.select("digest"), "digest", "left_semi")
    ends = rows.groupBy("digest").agg(F.min("plain").alias("_lo"), F.max("plain").alias("_hi"))
    return ends.where("_lo = _hi").select("digest")


def duplicates(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """Per row of both tables (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of each group of equal texts stays.
    """
    old, new = staged(digests(snapshot), "digests"), staged(digests(batch), "digests")
    buckets = 1 + max(old.count(), new.count()) // BUCKET_ROWS
    exact, filters = build_snapshot(old, buckets)
    fresh = staged(screen(_grouped(new), filters, buckets), "screened")
    met = fresh.where("maybe_held").join(
        exact.select("digest", F.col("last_id").alias("old_id"), F.col("n").alias("old_n")), "digest"
    )
    both = snapshot.select("text").unionByName(batch.select("text"))
    met = staged(met.join(_same_bytes(both, met), "digest"), "copies")
    merged = met.select(
        "digest", F.greatest("last_id", "old_id").alias("keep_id"), (F.col("n") + F.col("old_n")).alias("group_size")
    )
    apart = exact.select("digest", "last_id", "n").join(merged, "digest", "left_anti").unionByName(
        fresh.select("digest", "last_id", "n").join(merged, "digest", "left_anti")
    )
    groups = merged.unionByName(apart.select("digest", F.col("last_id").alias("keep_id"), F.col("n").alias("group_size")))
    return old.unionByName(new).join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_one(found: DataFrame) -> DataFrame:
    """One row (doc_id, text_sha256) for each group of equal texts."""
    return found.where("kept").select("doc_id", "text_sha256").distinct()
