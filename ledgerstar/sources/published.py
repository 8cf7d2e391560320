"""Tables that change by a switch: new data is written beside the old, and one small file makes it count.

A ``Manifest`` is a folder of small Parquet files, each the whole list of what a table consists of at one
time; the file of the highest place counts. Spark moves a finished file into the folder in one step, so
readers see the old list or the new one, and a writer that dies before leaves everything as it was. Lists
are few: with each switch all but the last ``keep`` go, and the data that only those named.

A published folder holds ``version-<id>`` folders and a manifest that names the present one. There is one
writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.session import delete_folder, exists, names_in, small_frame

VERSION = "version-"


def new_version() -> str:
    return f"{VERSION}{uuid.uuid4().hex}"


class Manifest:
    """Lists of rows under ``schema``, the last one of which counts."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder = spark, folder
        self.schema = T.StructType([T.StructField("place", T.LongType()), *T.DataType.fromDDL(schema)])

    def _held(self) -> list[Row]:
        if not exists(self.spark, self.folder):
            return []
        listed = self.spark.read.schema(self.schema).parquet(self.folder)
        return listed.select("*", F.col("_metadata.file_name").alias("_file")).collect()

    def rows(self) -> list[Row]:
        """The present list; empty while there is none."""
        held = self._held()
        last = max((r.place for r in held), default=None)
        return [r for r in held if r.place == last]

    def switch(self, rows: Sequence[tuple], keep: int = 2) -> list[Row]:
        """Make ``rows`` the present list and return those of the lists that are kept."""
        held = self._held()
        place = max((r.place for r in held), default=-1) + 1
        listed = small_frame(self.spark, [(place, *row) for row in rows], self.schema)
        listed.coalesce(1).write.mode("append").parquet(self.folder)
        # Only a finished switch lets old lists go.
        for name in {r._file for r in held if r.place <= place - keep}:
            delete_folder(self.spark, f"{self.folder}/{name}")
        return [r for r in held if r.place > place - keep]


def drop_versions(spark: SparkSession, folder: str, named: set[str]) -> None:
    """Delete the versions below ``folder`` that no kept list names: replaced ones, and those of dead writers."""
    for name in names_in(spark, folder):
        if name.startswith(VERSION) and name not in named:
            delete_folder(spark, f"{folder}/{name}")


@dataclass(frozen=True)
class Part:
    """A version that the present table consists of, and the folder its rows came from, where one is named."""

    version: str
    source: str | None = None


def _pointer(spark: SparkSession, folder: str) -> Manifest:
    return Manifest(spark, f"{folder.rstrip('/')}/current", "version string, part int, source string")


def current_parts(spark: SparkSession, folder: str) -> list[Part]:
    """The versions that count now, the latest first; none for a plain table."""
    rows = sorted(_pointer(spark, folder).rows(), key=lambda r: r.part)
    return [Part(r.version, r.source) for r in rows]


def current_path(spark: SparkSession, folder: str) -> str:
    """The folder that holds the present version; a plain table's own folder."""
    parts = current_parts(spark, folder)
    return f"{folder.rstrip('/')}/{parts[0].version}" if parts else folder.rstrip("/")


class NextVersion:
    """A version in the making: write below ``path``, then ``switch``, or ``discard`` it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.name = new_version()
        self.path = f"{self.folder}/{self.name}"

    def switch(self, keep: int = 2, source: str | None = None, earlier: Sequence[Part] = ()) -> None:
        """Make this the present version, over the ``earlier`` ones that it only adds to, and delete all
        versions that none of the last ``keep`` switches names."""
        parts = [Part(self.name, source), *earlier]
        kept = _pointer(self.spark, self.folder).switch([(p.version, i, p.source) for i, p in enumerate(parts)], keep)
        drop_versions(self.spark, self.folder, {*(p.version for p in parts), *(r.version for r in kept)})

    def discard(self) -> None:
        delete_folder(self.spark, self.path)
