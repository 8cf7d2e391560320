"""Ingest of files as they arrive: every micro-batch goes through the batch load unchanged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerstar.contracts import Contract
from ledgerstar.operators.audit import RunLog
from ledgerstar.operators.quality import Rule
from ledgerstar.plans.ingest import Targets, load_text
from ledgerstar.sources.csv_table import stream_text_table


def ingest_arrivals(
    spark: SparkSession,
    folder: str,
    targets: Targets,
    raw: Contract,
    stored: Contract,
    rules: Sequence[Rule],
    checkpoint: str,
    files_per_batch: int | None = None,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Load all files in ``folder`` that this checkpoint has not seen, then stop.

    Spark may repeat a batch after a failure. The content key makes the repeated load a no-op, and
    rejected records are kept once per file, whatever stream or batch brings the file.
    """

    def load(batch: DataFrame, number: int) -> None:
        log = RunLog(batch.sparkSession, targets.audit, f"batch-{number}")
        load_text(batch, f"{folder} batch {number}", targets, raw, stored, rules, log, partition_by)

    return (
        stream_text_table(spark, folder, raw, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
