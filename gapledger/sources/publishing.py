"""Runs that readers see whole or not at all.

Each run writes its tables into folders of its own, ``<folder>/<table>/run=<run>``, which
no reader looks into yet. When all are complete, one small manifest in
``<folder>/_manifests`` names them: for every table and date the folder that holds it. Manifests
are numbered; a new one is written aside and renamed to the next free number, so that it
appears in one step and two runs that end together can't hide each other. Readers follow
the manifest with the highest number. A run that fails leaves folders that no manifest
names, and every reader goes on with the run before.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapledger.sources.snapshots import DATE_COLUMN, write_snapshot

MANIFESTS = "_manifests"
RUN_COLUMN = "run"
_ATTEMPTS = 20


@dataclass
class Manifest:
    """What is published: table and date to the run that holds it, and what may be deleted."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    superseded: list[str] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps({"tables": self.tables, "superseded": self.superseded}, indent=1, sort_keys=True)

    def followed_by(self, run: str, names: list[str], date: dt.date) -> Manifest:
        """The manifest after ``run`` has published ``names`` for a date."""
        tables = {name: dict(runs) for name, runs in self.tables.items()}
        gone = list(self.superseded)
        for name in names:
            before = tables.setdefault(name, {}).get(date.isoformat())
            if before is not None:
                gone.append(f"{name}/{RUN_COLUMN}={before}")
            tables[name][date.isoformat()] = run
        return Manifest(self.number + 1, tables, gone)


class _Files:
    """The few file operations a manifest takes, on whatever file system the folder lies."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.folder = folder.rstrip("/")

    def _of(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def names(self, folder: str) -> list[str]:
        path = self._of(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def age_seconds(self, name: str) -> float:
        return time.time() - self._fs.getFileStatus(self._of(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._of(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write aside and rename; False if the name is taken."""
        folder, _, last = name.rpartition("/")
        aside = self._of(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            return not self._fs.exists(self._of(name)) and self._fs.rename(aside, self._of(name))
        finally:
            self._fs.delete(aside, False)

    def delete(self, name: str) -> None:
        self._fs.delete(self._of(name), True)


def latest_manifest(spark: SparkSession, folder: str) -> Manifest:
    """The manifest with the highest number; an empty one before the first run."""
    files = _Files(spark, folder)
    numbers = [int(n.removesuffix(".json")) for n in files.names(MANIFESTS) if n[:1].isdigit()]
    if not numbers:
        return Manifest()
    held = json.loads(files.read(f"{MANIFESTS}/{max(numbers):012d}.json"))
    return Manifest(max(numbers), held["tables"], held["superseded"])


def publish_run(
    spark: SparkSession, folder: str, date: dt.date, outputs: dict[str, DataFrame | Callable[[], DataFrame]],
    ordered: dict[str, str] | None = None, keep_superseded: bool = False,
) -> dict[str, str]:
    """Write all ``outputs`` of one run, then publish them in one step; the folders written.

    An output may be a function, called when its turn comes. ``ordered`` names the column by
    which a table's files are range-sorted. A rerun of a date takes the place of the earlier
    run, whose folders go after the manifest stands, unless they are to be kept for readers
    that are still at work; what a crash leaves there goes with a later run.
    """
    run = f"{date:%Y%m%d}-{uuid.uuid4().hex[:12]}"
    paths = {name: f"{folder.rstrip('/')}/{name}/{RUN_COLUMN}={run}" for name in outputs}
    for name, output in outputs.items():
        write_snapshot(output() if callable(output) else output, paths[name], date, (ordered or {}).get(name))
    _commit(spark, folder, run, list(outputs), date)
    if not keep_superseded:
        remove_superseded(spark, folder)
    return paths


def _commit(spark: SparkSession, folder: str, run: str, names: list[str], date: dt.date) -> None:
    files = _Files(spark, folder)
    for _ in range(_ATTEMPTS):
        # Another run may have published meanwhile: its manifest is what this one has to follow.
        after = latest_manifest(spark, folder).followed_by(run, names, date)
        if files.write_new(f"{MANIFESTS}/{after.number:012d}.json", after.text()):
            return
    raise RuntimeError(f"{folder}: {_ATTEMPTS} other runs were published first")


def remove_superseded(spark: SparkSession, folder: str) -> None:
    """Delete the folders of runs that a later one of the same date has replaced."""
    files = _Files(spark, folder)
    for name in latest_manifest(spark, folder).superseded:
        files.delete(name)


def remove_unpublished(spark: SparkSession, folder: str, older_than: dt.timedelta) -> list[str]:
    """Delete what failed runs have left: run folders in no manifest that have not changed for ``older_than``."""
    files, manifest = _Files(spark, folder), latest_manifest(spark, folder)
    gone = []
    for table in files.names("."):
        if table.startswith(("_", ".")):
            continue
        published = set(manifest.tables.get(table, {}).values())
        for name in files.names(table):
            held = f"{table}/{name}"
            run = name.removeprefix(f"{RUN_COLUMN}=")
            if run != name and run not in published and files.age_seconds(held) > older_than.total_seconds():
                files.delete(held)
                gone.append(held)
    return gone


def published_dates(spark: SparkSession, folder: str, name: str) -> list[dt.date]:
    return sorted(map(dt.date.fromisoformat, latest_manifest(spark, folder).tables.get(name, {})))


def read_published(
    spark: SparkSession, folder: str, name: str, dates: list[dt.date] | None = None
) -> DataFrame | None:
    """A table as published, with its ``report_date``: of all dates, or of some; None if there is none.

    The frame reads the runs that are published now, whatever is published later.
    """
    runs = latest_manifest(spark, folder).tables.get(name, {})
    wanted = runs if dates is None else {d.isoformat() for d in dates} & set(runs)
    if not wanted:
        return None
    base = f"{folder.rstrip('/')}/{name}"
    parts = [f"{base}/{RUN_COLUMN}={runs[d]}/{DATE_COLUMN}={d}" for d in sorted(wanted)]
    rows = spark.read.option("basePath", base).parquet(*parts).drop(RUN_COLUMN)
    # One date alone would be inferred like any other text; it is a date in any case.
    return rows.withColumn(DATE_COLUMN, F.col(DATE_COLUMN).cast("date"))


def latest_published(spark: SparkSession, folder: str, name: str, before: dt.date) -> DataFrame | None:
    """The table of the latest date before ``before``; None if there is none."""
    earlier = [d for d in published_dates(spark, folder, name) if d < before]
    return read_published(spark, folder, name, earlier[-1:]) if earlier else None
