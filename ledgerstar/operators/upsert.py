"""Idempotent loads into Parquet tables: insert if absent on a content key, replace on any key.

Parquet has no transactions, so a target has one writer at a time. An append that dies part-way is
repaired by running it again, as it leaves out what is there. A replacing load writes new versions of the
buckets it touches and makes them count by one switch, so a load that dies at any point has changed nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import Contract, exact, quoted, read_or_empty
from ledgerstar.operators.file_index import FileIndex
from ledgerstar.session import small_frame
from ledgerstar.sources.published import Manifest, drop_versions, new_version

# Keys that may be broadcast: a 32-character key costs under 100 bytes, so this stays below 100 MB.
MAX_BROADCAST_KEYS = 1_000_000
# Partition values that may be listed in a scan filter.
MAX_LISTED_PARTITIONS = 10_000
ROWS_PER_BUCKET = 2_000_000

BUCKET = "key_bucket"
_FROM_BATCH = "_from_batch"


@dataclass(frozen=True)
class LoadResult:
    rows_before: int
    rows_after: int
    batch_rows: int


def distinct_by_key(batch: DataFrame, key: str) -> DataFrame:
    """One row per content key; copies fold inside each task before the shuffle."""
    return batch.dropDuplicates([key])


def absent_from(
    batch: DataFrame,
    stored: DataFrame,
    key: str,
    batch_rows: int,
    stored_rows: int,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Distinct rows of ``batch`` whose key is not in ``stored``, which holds each key once.

    A batch with few rows goes to a larger table's keys: they are scanned in place and only the keys
    in conflict come back, at most one per batch row. Rows in conflict leave before copies are folded,
    so a batch that holds nothing new shuffles nothing wide. A larger batch meets the stored keys in
    one shuffle on the key, which also serves the fold of copies, unless Spark's own size threshold
    lets the stored keys be broadcast.
    """
    keys = stored.select(exact(key))
    if batch_rows <= max_broadcast and batch_rows < stored_rows:
        conflicts = keys.join(F.broadcast(batch.select(exact(key))), key, "left_semi")
        return distinct_by_key(batch.join(F.broadcast(conflicts), key, "left_anti"), key)
    return distinct_by_key(batch, key).join(keys, key, "left_anti")


def insert_if_absent(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    contract: Contract,
    partition_by: str | None = None,
    batch_rows: int | None = None,
    run_id: str = "load",
) -> LoadResult:
    """Append the rows of ``batch`` whose content key the table at ``path`` lacks.

    ``batch`` should be a written table, as it is read twice. The files of the table are indexed by key,
    so a batch that may be broadcast is looked for in those files alone that can hold one of its keys.
    ``partition_by`` names a contract column to lay the table out by instead; rows with equal content
    agree on it, so only the partitions the batch touches are searched.
    """
    (key,) = contract.key
    if batch_rows is None:
        batch_rows = batch.count()
    batch = contract.project(batch)
    if partition_by:
        return _insert_into_partitions(spark, batch, path, contract, partition_by, batch_rows)
    index = FileIndex(spark, path, key, contract.schema)
    held = index.held()
    rows_before = index.count(held)
    few = batch_rows <= MAX_BROADCAST_KEYS and batch_rows < rows_before
    stored = index.read(index.candidates(batch, held) if few else held.files)
    n_new = _append(absent_from(batch, stored, key, batch_rows, rows_before), path)
    if n_new:
        index.record(held, run_id, int(spark.conf.get("spark.sql.shuffle.partitions")))
    elif held.files:
        index.drop_new(held)  # a file without rows
    return LoadResult(rows_before, rows_before + n_new, batch_rows)


def _insert_into_partitions(
    spark: SparkSession, batch: DataFrame, path: str, contract: Contract, partition_by: str, batch_rows: int
) -> LoadResult:
    (key,) = contract.key
    target = read_or_empty(spark, contract.schema, path)
    rows_before = target.count()
    stored = _touched(target, batch, partition_by)
    # Rows of one partition value go to few files; AQE splits a value that is too large.
    rows = absent_from(batch, stored, key, batch_rows, rows_before).hint("rebalance", quoted(partition_by))
    return LoadResult(rows_before, rows_before + _append(rows, path, partition_by), batch_rows)


def _append(rows: DataFrame, path: str, *layout: str) -> int:
    written = Observation("written")
    counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
    counted.write.mode("append").partitionBy(*layout).parquet(path)
    return written.get["n"]


def latest_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key; further ties go to the greatest content.

    An aggregate and not a window: a key with a third of all rows folds inside each task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order_by]
    ordered = F.max(F.struct(*[exact(c) for c in [*order_by, *rest]])).alias("_latest")
    latest = rows.groupBy(*[exact(k) for k in keys]).agg(ordered)
    return latest.select(
        *[
            exact(c) if c in keys else F.col("_latest").getField(c).alias(c)
            for c in rows.columns
        ]
    )


def _buckets(spark: SparkSession, path: str) -> Manifest:
    return Manifest(spark, f"{path.rstrip('/')}/_buckets", "bucket int, n_buckets int, version string, n_rows bigint")


def _read_buckets(spark: SparkSession, path: str, schema: T.StructType, rows: Iterable[Row]) -> DataFrame:
    folders = [f"{path.rstrip('/')}/{r.version}/{BUCKET}={r.bucket}" for r in rows]
    return spark.read.schema(schema).parquet(*folders) if folders else small_frame(spark, [], schema)


def replace_on_key(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    contract: Contract,
    order_by: Sequence[str],
    buckets: int | None = None,
) -> LoadResult:
    """Insert rows by ``contract.key``, replacing stored rows with the same key, all of them or none.

    The table is laid out by a hash bucket of the key. A load reads the buckets that its batch touches,
    writes new versions of them beside the old, and appends one list of all buckets' versions: that is the
    switch. Whenever a load dies, readers have the whole table as it was before or after. Versions that
    neither of the last two lists names are deleted by the next load.

    Buckets bound what a small batch rewrites, not how many tasks work: rows are
    merged by key, and the written buckets are cut into files as they need. The first load sets the
    number of buckets, by default one for every ``ROWS_PER_BUCKET`` rows; it stays for the table's life.
    """
    keys = list(contract.key)
    manifest = _buckets(spark, path)
    stored = {r.bucket: r for r in manifest.rows()}
    batch_rows = batch.count()
    laid_out = next((r.n_buckets for r in stored.values()), None)
    if laid_out and buckets not in (None, laid_out):
        raise ValueError(f"{path} was laid out with {laid_out} buckets, not {buckets}")
    buckets = laid_out or buckets or max(1, math.ceil(batch_rows / ROWS_PER_BUCKET))

    rows = contract.project(batch)
    bucket = F.pmod(F.xxhash64(*[exact(k) for k in keys]), F.lit(buckets)).cast("int")
    touched = {r[0] for r in rows.select(bucket).distinct().collect()}  # as many as there are buckets
    rows_before = sum(r.n_rows for r in stored.values())
    if not touched:
        return LoadResult(rows_before, rows_before, batch_rows)
    kept = _read_buckets(spark, path, contract.schema, (r for b, r in stored.items() if b in touched))
    winners = latest_per_key(rows, keys, order_by)
    both = kept.withColumn(_FROM_BATCH, F.lit(False)).unionByName(winners.withColumn(_FROM_BATCH, F.lit(True)))
    merged = latest_per_key(both, keys, [_FROM_BATCH]).drop(_FROM_BATCH).withColumn(BUCKET, bucket)
    version = new_version()
    # Merged by key, as many tasks as there are; a bucket too large for one file is split by AQE.
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path.rstrip('/')}/{version}")
    written = spark.read.parquet(f"{path.rstrip('/')}/{version}").groupBy(BUCKET).count().collect()
    following = {**{b: (r.version, r.n_rows) for b, r in stored.items()}, **{r[0]: (version, r[1]) for r in written}}
    earlier = manifest.switch([(b, buckets, name, n) for b, (name, n) in sorted(following.items())])
    drop_versions(spark, path, {name for name, _ in following.values()} | {r.version for r in earlier})
    return LoadResult(rows_before, sum(n for _, n in following.values()), batch_rows)


def read_keyed(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The present rows of a table written by ``replace_on_key``."""
    return _read_buckets(spark, path, contract.schema, _buckets(spark, path).rows())


def _touched(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """The partitions of ``target`` that hold any value of ``column`` in ``batch``.

    Few values are listed, so the scan opens no other partition. More of them meet the table's rows in
    a semi-join: other partitions are read for their values, but never returned, kept or rewritten.
    """
    touched = batch.select(exact(column).alias("_touched")).distinct()
    rows = touched.take(MAX_LISTED_PARTITIONS + 1)
    if len(rows) > MAX_LISTED_PARTITIONS:
        return target.join(touched, exact(column).eqNullSafe(F.col("_touched")), "left_semi")
    values = [r[0] for r in rows if r[0] is not None]
    listed = exact(column).isin(values) if values else F.lit(False)
    if len(values) < len(rows):
        listed = listed | exact(column).isNull()
    return target.filter(listed)
