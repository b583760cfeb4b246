"""Loads: every landed file goes into the landing tables exactly once, under its own run.

Files that one run of the extract requested lie below ``run=<time>``:

    <landing>/<endpoint>/brand_id=b1/run=2026-05-19T06-00-00/0.json

A load takes the files of one run that no committed load has. Its rows go to ``<table>/load=<id>`` and the list of its files
(endpoint, run, file) to the ledger, and only then is the load committed, so a load counts wholly or not at all. Readers see
committed loads alone. Runs are loaded in the order of their times and rows are stamped with the time of their run: runs
that landed side by side give the same tables as runs loaded one by one, and a repeated load finds nothing to do.

Files that lie in no run's folder belong to the run that loads them. Files of a run that arrive later make another load of that run.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import staged
from . import commits
from .payloads import LINES, WHOLE, file_name

LOAD = "load"
_FILE_COLUMNS = "pipeline string, endpoint string, run string, file string"


def run_clock(run: str | None, otherwise: datetime) -> datetime:
    """The time named by a run: year, month, day and as much of the clock as there is, in UTC."""
    parts = [int(n) for n in re.findall(r"\d+", run or "")][:6]
    try:
        return datetime(*parts, tzinfo=timezone.utc) if len(parts) >= 3 else otherwise
    except ValueError:
        return otherwise


@dataclass
class Load:
    """The files of one run that are being loaded by a pipeline."""

    ledger: Ledger
    pipeline: str
    run: str | None
    time: datetime
    files: DataFrame
    endpoints: frozenset[str]
    id: str

    def rows_of(self, payloads: DataFrame, endpoint: str) -> DataFrame:
        """The payloads of this load among all of an endpoint (with ``run`` and ``file``); the run prunes folders."""
        files = self.files.where(F.col("endpoint") == endpoint).select("file")
        own = payloads.where(F.col("run").eqNullSafe(F.lit(self.run)))
        return own.join(files, "file", "left_semi").drop("file")

    def append(self, rows: DataFrame, path: str) -> None:
        """Store rows, unseen until the load is committed."""
        rows.write.parquet(f"{path}/{LOAD}={self.id}")

    def commit(self) -> None:
        """Let readers see the load."""
        self.files.withColumn("pipeline", F.lit(self.pipeline)).write.parquet(f"{self.ledger.folder}/files/{LOAD}={self.id}")
        number, content = commits.newest(self.ledger.spark, f"{self.ledger.folder}/_commits")
        held = [*content.get("loads", []), self.id]
        commits.commit(self.ledger.spark, f"{self.ledger.folder}/_commits", number + 1, {"loads": held})


class Ledger:
    """The committed loads below a warehouse's root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.folder = f"{root.rstrip('/')}/loads"

    def committed(self) -> list[str]:
        """Ids of all loads, oldest first: one per run and pipeline."""
        return commits.newest(self.spark, f"{self.folder}/_commits")[1].get("loads", [])

    def rows(self, path: str, schema: StructType, loads: Sequence[str] | None = None) -> DataFrame:
        """Rows of committed loads (of ``loads``, if given), with the column ``load``."""
        wanted = self.committed() if loads is None else list(loads)
        full = StructType(list(schema.fields)).add(LOAD, "string")
        return self.spark.read.schema(full).parquet(path).where(F.col(LOAD).isin(wanted) if wanted else F.lit(False))

    def files(self) -> DataFrame:
        """Files of all committed loads: pipeline, endpoint, run, file, load."""
        folder = f"{self.folder}/files"
        if not commits.exists(self.spark, folder):
            return self.spark.createDataFrame([], f"{_FILE_COLUMNS}, {LOAD} string")
        return self.rows(folder, StructType.fromDDL(_FILE_COLUMNS))

    def landed(self, landing: str, endpoints: Sequence[str]) -> DataFrame:
        """All landed files by their names alone: endpoint, run, file."""
        parts = []
        for endpoint in endpoints:
            path = f"{landing.rstrip('/')}/{endpoint}"
            if commits.exists(self.spark, path):
                # Of binary files only their names are asked for, so none is opened.
                for names in (WHOLE, LINES):
                    found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                    found = found.option("pathGlobFilter", names).load(path)
                    parts.append(found.select(F.lit(endpoint).alias("endpoint"), file_name().alias("file")))
        if not parts:
            return self.spark.createDataFrame([], "endpoint string, run string, file string")
        found = reduce(DataFrame.unionByName, parts)
        run = F.nullif(F.regexp_extract("file", "/run=([^/]*)/", 1), F.lit(""))
        return found.select("endpoint", run.alias("run"), "file")

    def pending(self, landing: str, pipeline: str, endpoints: Sequence[str], run_time: datetime) -> list[Load]:
        """Loads to make, in the order of their runs. ``run_time`` is the time of files without a run."""
        known = self.files().where(F.col("pipeline") == pipeline).select("endpoint", "file")
        fresh = staged(self.landed(landing, endpoints).join(known, ["endpoint", "file"], "left_anti"), "files")
        # A row per run that has new files.
        runs = fresh.groupBy("run").agg(F.collect_set("endpoint").alias("endpoints")).collect()
        # Files without a run come last: they belong to the present run.
        runs.sort(key=lambda r: (run_clock(r["run"], run_time), r["run"] is None, r["run"] or ""))
        return [
            Load(
                self, pipeline, r["run"], run_clock(r["run"], run_time),
                fresh.where(F.col("run").eqNullSafe(F.lit(r["run"]))), frozenset(r["endpoints"]), uuid.uuid4().hex,
            )
            for r in runs
        ]

    def append(self, tables: dict[str, DataFrame], pipeline: str = "direct") -> str:
        """Load rows that come from no file, as one load: path to rows (stamped already). Gives the load's id."""
        none = self.spark.createDataFrame([], "endpoint string, run string, file string")
        load = Load(self, pipeline, None, datetime.now(timezone.utc), none, frozenset(), uuid.uuid4().hex)
        for path, rows in tables.items():
            load.append(rows, path)
        load.commit()
        return load.id

    def forget(self) -> None:
        """Drop all loads: their rows are no longer seen and their files can be loaded anew."""
        number, content = commits.newest(self.spark, f"{self.folder}/_commits")
        if content.get("loads"):
            commits.commit(self.spark, f"{self.folder}/_commits", number + 1, {"loads": []})

    def sweep(self, paths: Sequence[str]) -> int:
        """Delete folders of loads that were never committed or are forgotten; says how many. No load may be running."""
        held, swept = set(self.committed()), 0
        for path in (*paths, f"{self.folder}/files"):
            for name in commits.children(self.spark, path):
                if name.startswith(f"{LOAD}=") and name.removeprefix(f"{LOAD}=") not in held:
                    commits.remove(self.spark, f"{path}/{name}")
                    swept += 1
        return swept
