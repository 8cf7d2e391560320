"""Dense row ids 1..n without a window over the data.

A row of a written Parquet table has a fixed place: its file, and its index inside that file. The
id is the number of rows in earlier files plus that index plus one. Only one row per file meets in
a single task; the data itself is neither shuffled nor sorted to be numbered, and a retried task
computes the same ids because the files do not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import exact
from ledgerstar.session import Scratch

# One offset row per file is about 200 bytes, so a hinted broadcast stays below 200 MB.
MAX_BROADCAST_FILES = 1_000_000

_FILE = "_id_file"
_INDEX = "_id_index"
_OFFSET = "_id_offset"


def file_offsets(written: DataFrame) -> DataFrame:
    """Rows held by the files before each file, in the order the files were numbered on write."""
    per_file = written.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    # A task writes part-<number>-<job>-c<file number>; both numbers outgrow their zero padding.
    part = F.regexp_extract(_FILE, r"part-(\d+)[^/]*$", 1).try_cast("bigint")
    job = F.regexp_replace(_FILE, r"-c\d+\.[^/]*$", "")
    number = F.regexp_extract(_FILE, r"-c(\d+)\.[^/]*$", 1).try_cast("bigint")
    place = [key.asc_nulls_last() for key in (part, job, number, F.col(_FILE))]
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    return per_file.select(
        _FILE, F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).cast("bigint").alias(_OFFSET)
    )


def with_file_order_ids(
    spark: SparkSession,
    folder: str,
    id_name: str,
    id_type: str = "bigint",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Number the rows of the whole Parquet table in ``folder``.

    The offsets come from a scan that reads no column, and ride to the data in a broadcast as long
    as the table has a broadcastable number of files.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    written = reader.parquet(folder)
    offsets = file_offsets(written)
    if len(written.inputFiles()) <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    placed = written.select(
        "*",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.row_index").alias(_INDEX),
    )
    position = F.col(_OFFSET) + F.col(_INDEX) + 1
    return (
        placed.join(offsets, _FILE, "inner")
        .withColumn(id_name, position.cast(id_type))
        .drop(_FILE, _INDEX, _OFFSET)
    )


def with_ordered_ids(
    written: DataFrame,
    order_by: Sequence[Column],
    scratch: Scratch,
    id_name: str,
    id_type: str = "bigint",
) -> DataFrame:
    """Number rows 1..n along ``order_by``, ascending with NULLs last.

    The table is written globally sorted and then numbered by place. A digest of each row's place in
    ``written`` ends the sort key and tells equal keys apart, so a value or a group of copies that
    fills a third of the table is cut into as many ranges as it needs.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    # Keys become columns first: a sort would evaluate an expression again at every comparison.
    keys = {f"_key{i}": key for i, key in enumerate([*order_by, place])}
    keyed = written.select("*", *[key.alias(name) for name, key in keys.items()])
    ranged = keyed.orderBy(*[F.col(name).asc_nulls_last() for name in keys]).drop(*keys)
    name = f"sorted_{id_name}"
    schema = scratch.store(ranged, name).schema
    return with_file_order_ids(scratch.spark, scratch.path(name), id_name, id_type, schema)


LANES = (0, 16, 32, 48)


def _checksum(key: Column) -> list[Column]:
    """Sums that depend on which keys there are and how often, and not on their order.

    A key's 64-bit hash is added in four lanes of 16 bits, so 10**13 rows do not overflow a BIGINT.
    """
    mark = F.xxhash64(key.cast("bigint"))
    lanes = [F.sum(F.shiftrightunsigned(mark, at).bitwiseAND(F.lit(0xFFFF))) for at in LANES]
    return [F.coalesce(lane, F.lit(0)).alias(f"lane{at}") for lane, at in zip(lanes, LANES, strict=True)]


def rows_without_dense_key(df: DataFrame, key: str) -> int:
    """0 where ``key`` holds every number from 1 to the number of rows once; else about how many rows do not.

    No row is shuffled: each task sums up its keys, and the sums are set against those of the numbers
    themselves, which Spark counts through without a table. Keys that are not dense pass with a chance
    of 2**-64.
    """
    column = exact(key)
    held = df.agg(
        F.count(F.lit(1)).alias("n"), F.count(column).alias("keys"), F.min(column).alias("low"), F.max(column).alias("high"), *_checksum(column)
    ).first()
    if held.keys < held.n:
        return held.n - held.keys
    if held.n and (held.low, held.high) != (1, held.n):
        return 1
    expected = df.sparkSession.range(1, held.n + 1).agg(*_checksum(F.col("id"))).first()
    return 0 if all(held[lane] == expected[lane] for lane in expected.asDict()) else 1
