"""A profile that grows with its table: rows, missing cells and exact distinct values of every column.

Sums of rows and missing cells add up over loads; distinct values do not, so the store keeps them. A refresh
reads the files that came since the last one, folds their cells to distinct values, and sets these against the
stored ones; only values that are new are added. The table's earlier files are not opened again.

The store is a list of runs, switched in one step, each with its files, its new values and its totals. Values
of one run occur in no other, so distinct counts add up over runs. After ``MERGED_AT`` runs they are put
together into one, which copies each value once in as many refreshes. A writer that dies before the switch has
changed nothing. There is one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.operators.profile import any_present, cells_by_type
from ledgerstar.session import Scratch, exists, small_frame
from ledgerstar.sources.published import Manifest, drop_versions, new_version

FILES = T.StructType().add("path", "string").add("length", "long").add("changed", "long")
LANES = {"whole": "long", "real": "double", "moment": "timestamp_ntz", "text": "string"}
VALUES = reduce(lambda fields, lane: fields.add(*lane), LANES.items(), T.StructType().add("column_name", "string"))
REPORT = "column_name string, n_rows bigint, n_missing bigint, n_distinct bigint"
TOTALS = f"version string, signature string, {REPORT}"

MERGED_AT = 16
# New values that may be broadcast: at most 63 characters each, so at most about 64 MB.
FEW_VALUES = 200_000


class StoredProfile:
    """The profile of ``columns`` of the Parquet table below ``table``, kept below ``store``.

    ``schema`` is the table's; a file that lacks one of the columns counts NULLs for it. Files that are
    gone or were changed, and columns or types other than those in the store, make the next refresh read
    the whole table. A folder that is not there is an empty table.
    """

    def __init__(self, spark: SparkSession, table: str, store: str, schema: T.StructType, columns: Sequence[str] | None = None):
        self.spark, self.table, self.store = spark, table.rstrip("/"), store.rstrip("/")
        self.schema, self.columns = schema, list(columns or schema.names)
        self.signature = json.dumps([[c, schema[c].dataType.simpleString()] for c in self.columns])
        self._runs = Manifest(spark, f"{self.store}/current", TOTALS)

    def report(self) -> DataFrame:
        """``column_name, n_rows, n_missing, n_distinct`` as of the last refresh; nothing is read but the list."""
        return self._report(self._runs.rows())

    def refresh(self) -> DataFrame:
        """The report after the files that came since the last refresh are taken in."""
        there = self._files()
        held = [r for r in self._runs.rows() if r.signature == self.signature]
        if held and not self._intact(held, there):
            held = []
        seen = self._stored(held, "files", FILES)
        new = there.join(seen, "path", "left_anti").collect()  # one row per file that is new
        if new or not held:
            self._add(held, new)
        return self.report()

    def _files(self) -> DataFrame:
        """The table's files by path, size and time; contents are not read."""
        if not exists(self.spark, self.table):
            return small_frame(self.spark, [], FILES)
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        return listed.load(self.table).select("path", "length", F.unix_micros("modificationTime").alias("changed"))

    def _intact(self, held: Sequence[Row], there: DataFrame) -> bool:
        """Whether every file that was read is there as it was."""
        return self._stored(held, "files", FILES).join(there, FILES.names, "left_anti").isEmpty()

    def _stored(self, held: Sequence[Row], part: str, schema: T.StructType) -> DataFrame:
        paths = [f"{self.store}/{v}/{part}" for v in dict.fromkeys(r.version for r in held)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else small_frame(self.spark, [], schema)

    def _read(self, files: Sequence[Row]) -> DataFrame:
        if not files:
            return small_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.table).parquet(*[f.path for f in files])

    def _add(self, held: Sequence[Row], new: Sequence[Row]) -> None:
        version = new_version()
        folder = f"{self.store}/{version}"
        scratch = Scratch(self.spark)
        try:
            cells, lanes = cells_by_type(self._read(new), self.columns)
            folded = scratch.store(cells.groupBy("column_no", *lanes).agg(F.count(F.lit(1)).alias("n")), "folded")
            present = any_present(lanes)
            sums = folded.groupBy("column_no").agg(
                F.sum("n").alias("n_rows"), F.sum(F.when(~present, F.col("n")).otherwise(0)).alias("n_missing")
            )
            rows = {r.column_no: r for r in sums.collect()}  # one row per column
            values = self._values(folded.filter(present), lanes)
            self._unseen(values, held).write.parquet(f"{folder}/values")
        finally:
            scratch.drop()
        listed = small_frame(self.spark, [tuple(f) for f in new], FILES)
        listed.coalesce(1).write.parquet(f"{folder}/files")
        written = self.spark.read.schema(VALUES).parquet(f"{folder}/values")
        distinct = {r[0]: r[1] for r in written.groupBy("column_name").count().collect()}  # one row per column
        added = [
            (version, self.signature, c, rows[i].n_rows if i in rows else 0, rows[i].n_missing if i in rows else 0, distinct.get(c, 0))
            for i, c in enumerate(self.columns)
        ]
        earlier = [(r.version, self.signature, *_totals(r)) for r in held]
        self._switch([*earlier, *added])

    def _values(self, folded: DataFrame, lanes: Sequence[str]) -> DataFrame:
        name = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("column_no") + 1)
        typed = [(F.col(lane) if lane in lanes else F.lit(None)).cast(kind).alias(lane) for lane, kind in LANES.items()]
        return folded.select(name.alias("column_name"), *typed)

    def _unseen(self, values: DataFrame, held: Sequence[Row]) -> DataFrame:
        """``values`` that no run holds. A few of them are looked for in the stored ones where those lie;
        only many make the stored ones move."""
        if not held:
            return values
        stored = self._stored(held, "values", VALUES)
        if values.limit(FEW_VALUES + 1).count() <= FEW_VALUES:
            stored = stored.alias("old").join(F.broadcast(values.alias("new")), _equal(), "left_semi")
        return values.alias("new").join(stored.alias("old"), _equal(), "left_anti")

    def _switch(self, rows: list[tuple]) -> None:
        """Make these totals the present list; runs that are many become one."""
        versions = list(dict.fromkeys(r[0] for r in rows))
        if len(versions) >= MERGED_AT:
            merged = new_version()
            for part, schema in (("values", VALUES), ("files", FILES)):
                parts = [f"{self.store}/{v}/{part}" for v in versions]
                self.spark.read.schema(schema).parquet(*parts).write.parquet(f"{self.store}/{merged}/{part}")
            rows = [(merged, self.signature, *totals) for totals in _summed(r[2:] for r in rows)]
            versions = [merged]
        kept = self._runs.switch(rows)
        drop_versions(self.spark, self.store, {*versions, *(r.version for r in kept)})

    def _report(self, held: Sequence[Row]) -> DataFrame:
        return small_frame(self.spark, _summed(_totals(r) for r in held if r.signature == self.signature), REPORT)


def _equal() -> Column:
    """Equal column and value; a value fills one lane, the others are NULL on both sides."""
    lanes = [F.col(f"new.{lane}").eqNullSafe(F.col(f"old.{lane}")) for lane in LANES]
    return reduce(lambda a, b: a & b, lanes, F.col("new.column_name") == F.col("old.column_name"))


def _totals(row: Row) -> tuple:
    return row.column_name, row.n_rows, row.n_missing, row.n_distinct


def _summed(totals: Iterable[tuple]) -> list[tuple]:
    """``(column, sums...)`` over all runs, in the order in which columns come first."""
    sums: dict[str, list[int]] = {}
    for column, *counts in totals:
        sums[column] = [a + b for a, b in zip(sums.get(column, [0] * len(counts)), counts, strict=True)]
    return [(column, *counts) for column, counts in sums.items()]
