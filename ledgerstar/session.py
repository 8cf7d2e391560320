"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

# What the results depend on: calendar dates must not move with the host's zone, and a bad cast
# must never turn into a silent NULL.
PARITY_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for the dots of a Spark key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PARITY_SETTINGS, **ADAPTIVE_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application.

    Functions are pickled by the name of their module, so workers must be able to import it: they are
    started in other folders and, on a cluster, on machines where it is not installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    # The driver serves this file itself; workers fetch it from there.
    path = Path(os.path.realpath(tempfile.mkdtemp(prefix="ship-"))) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, without a job or a Python worker."""
    fields = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), fields)


def _in_store(spark: SparkSession, path: str):
    """The store that ``path`` lies in, and the path as that store names it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    store, found = _in_store(spark, path)
    return store.exists(found)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders right below ``folder``; none if it is not there."""
    store, found = _in_store(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(found)) if store.exists(found) else []


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete ``folder`` in whatever store it lies; nothing happens if it is not there."""
    store, found = _in_store(spark, folder)
    store.delete(found, True)


class Scratch:
    """A fresh folder for tables that cut lineage, below the cluster's checkpoint folder.

    Every job that needs a frame twice writes it here once, so a lost executor costs a re-read and
    not a recomputation that might come out in another order. Whoever makes one drops it as soon as no
    result reads from it. What a lazy result still reads belongs to the session: ``drop_all`` deletes
    it, at the latest when the program ends.
    """

    _open: list[Scratch] = []  # noqa: RUF012

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_root(spark)).rstrip('/')}/ledgerstar-{uuid.uuid4().hex}"
        Scratch._open.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete this folder; call it once nothing reads from it any more."""
        delete_folder(self.spark, self.root)
        if self in Scratch._open:
            Scratch._open.remove(self)

    @staticmethod
    def drop_all() -> None:
        """Delete every scratch folder that this program has not dropped yet."""
        for scratch in list(Scratch._open):
            with contextlib.suppress(Exception):  # the session may be gone already
                scratch.drop()


atexit.register(Scratch.drop_all)


def shared_root(spark: SparkSession) -> str:
    """The folder named by the session; a machine-local one only when Spark itself is local."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="ledgerstar-")
