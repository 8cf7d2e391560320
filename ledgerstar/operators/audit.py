"""Run log: one row per run and step, appended to a table."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.session import small_frame

AUDIT_SCHEMA = (
    "run_id string, ts timestamp, step string, rows_in bigint, rows_out bigint, "
    "rejected bigint, status string, message string"
)


class RunLog:
    """Steps are held until ``flush``, which appends them in one write."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark = spark
        self.path = path
        self.run_id = run_id or uuid.uuid4().hex
        self._held: list[tuple] = []

    def add(
        self,
        step: str,
        message: str,
        rows_in: int | None = None,
        rows_out: int | None = None,
        rejected: int | None = None,
        status: str = "OK",
    ) -> None:
        now = datetime.now(timezone.utc)
        self._held.append((self.run_id, now, step, rows_in, rows_out, rejected, status, message))

    def fail(self, step: str, error: Exception) -> None:
        self.add(step, f"ERROR: {error}", status="ERROR")
        self.flush()

    def flush(self) -> None:
        entries = small_frame(self.spark, self._held, AUDIT_SCHEMA).coalesce(1)
        entries.write.mode("append").parquet(self.path)
        self._held = []

    def read(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path)


def log_line() -> Column:
    """A log row as text: ``[yyyy-MM-dd HH:mm:ss] message``."""
    return F.format_string("[%s] %s", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("message"))


def log_lines(audit: DataFrame) -> DataFrame:
    """The log as text lines, oldest first."""
    return audit.orderBy(F.col("ts").asc_nulls_last()).select(log_line().alias("line"))
