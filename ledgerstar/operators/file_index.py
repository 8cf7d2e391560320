"""What each file of an appended table holds: the run that wrote it, its rows, and the key buckets they are in.

The index is a small Parquet table in a hidden folder of the table. It answers three questions without a
look into the table: how many rows it has, which files can hold any of some keys, and what a run wrote,
so that the run can be undone.

Rows that leave a shuffle on their key lie in files by ``hash(key) mod n``, ``n`` being the number of shuffle
partitions of the load that wrote them. A file of a large load therefore holds one of n buckets, or a few, and
a key is looked for in about one file of each load instead of all. The index is a help and never
the truth: a file that it does not know, because a load died before it was recorded, is always looked
into, and recorded with the next load; a file that is gone is passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import exact, read_or_empty
from ledgerstar.session import delete_folder, names_in, small_frame

INDEX_FOLDER = "_files"
INDEX = (
    T.StructType().add("file", "string").add("run_id", "string").add("n_buckets", "integer").add("bucket", "integer").add("n_rows", "long")
)
# A target of fewer files is searched as a whole: choosing among them would take longer.
FILES_WORTH_CHOOSING = 16


@dataclass(frozen=True)
class Held:
    """The files of a table now, the rows of those that the index knows, and the bucket counts in use."""

    files: tuple[str, ...]
    rows: dict[str, int]
    bucket_counts: tuple[int, ...]

    @property
    def unknown(self) -> tuple[str, ...]:
        return tuple(f for f in self.files if f not in self.rows)


class FileIndex:
    """The index of the table at ``path``, whose rows are told apart by ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType):
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, INDEX, f"{self.path}/{INDEX_FOLDER}")

    def read(self, files: tuple[str, ...]) -> DataFrame:
        if not files:
            return small_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in files])

    def held(self) -> Held:
        """One row per file and load comes back."""
        files = tuple(n for n in names_in(self.spark, self.path) if not n.startswith(("_", ".")))
        if not files:
            return Held((), {}, ())
        known = self.entries().groupBy("file", "n_buckets").agg(F.sum("n_rows").alias("n_rows")).collect()
        there = set(files)
        present = [r for r in known if r.file in there]
        return Held(files, {r.file: r.n_rows for r in present}, tuple(sorted({r.n_buckets for r in present})))

    def count(self, held: Held) -> int:
        """Rows of the table; only files that the index does not know are opened, for their footers."""
        return sum(held.rows.values()) + (self.read(held.unknown).count() if held.unknown else 0)

    def candidates(self, batch: DataFrame, held: Held) -> tuple[str, ...]:
        """The files that can hold a key of ``batch``, among them all that the index does not know."""
        if len(held.files) < FILES_WORTH_CHOOSING:
            return held.files
        code = F.hash(exact(self.key))
        places = [F.struct(F.lit(n).alias("n_buckets"), F.pmod(code, F.lit(n)).alias("bucket")) for n in held.bucket_counts]
        touched = batch.select(F.explode(F.array(*places)).alias("at")).select("at.*").distinct()
        found = self.entries().join(touched, ["n_buckets", "bucket"]).select("file").distinct().collect()
        among = {r.file for r in found}
        return tuple(f for f in held.files if f in among or f not in held.rows)

    def record(self, before: Held, run_id: str, n_buckets: int) -> None:
        """Add what the index lacks: the files of this run, and those that an earlier one failed to record."""
        there = {*before.files}
        new = [n for n in names_in(self.spark, self.path) if not n.startswith(("_", ".")) and n not in there]
        runs = [(tuple(new), run_id), (before.unknown, "unrecorded")]
        for files, run in runs:
            if files:
                buckets = self.read(files).select(
                    F.col("_metadata.file_name").alias("file"),
                    F.lit(run).alias("run_id"),
                    F.lit(n_buckets).alias("n_buckets"),
                    F.pmod(F.hash(exact(self.key)), F.lit(n_buckets)).alias("bucket"),
                )
                entries = buckets.groupBy(*buckets.columns).agg(F.count(F.lit(1)).alias("n_rows"))
                # Spark also writes files without rows; each file has an entry all the same.
                marks = small_frame(self.spark, [(f, run, n_buckets, None, 0) for f in files], INDEX)
                entries.unionByName(marks).coalesce(1).write.mode("append").parquet(f"{self.path}/{INDEX_FOLDER}")

    def drop_new(self, before: Held) -> None:
        """Delete the files that came after ``before``."""
        there = {*before.files}
        for name in names_in(self.spark, self.path):
            if not name.startswith(("_", ".")) and name not in there:
                delete_folder(self.spark, f"{self.path}/{name}")


def rows_per_run(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, file, n_rows`` of every file that is there, as far as its run is recorded."""
    files = [(n,) for n in names_in(spark, path) if not n.startswith(("_", "."))]
    present = small_frame(spark, files, "file string")
    entries = read_or_empty(spark, INDEX, f"{path.rstrip('/')}/{INDEX_FOLDER}")
    return entries.join(present, "file").groupBy("run_id", "file").agg(F.sum("n_rows").alias("n_rows"))


def undo_run(spark: SparkSession, path: str, run_id: str) -> int:
    """Take back what one run appended, and return the rows that went.

    Whole files go, as a file is written by one run. Undoing again, or after a crash, takes the rest.
    Later runs found the run's rows there and did not bring them again: load their sources once more.
    """
    gone = rows_per_run(spark, path).filter(F.col("run_id") == run_id).collect()  # one row a file of the run
    for row in gone:
        delete_folder(spark, f"{path.rstrip('/')}/{row.file}")
    return sum(r.n_rows for r in gone)
