"""Re-runnable ingest: read, check, fingerprint, land once, load what is new, log every step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.contracts import Contract, ContractError, Field, exact
from ledgerstar.functions.fingerprint import with_fingerprint
from ledgerstar.operators.audit import RunLog
from ledgerstar.operators.quality import Rule, classify
from ledgerstar.operators.upsert import LoadResult, insert_if_absent
from ledgerstar.session import Scratch
from ledgerstar.sources.csv_table import (
    RAW_RECORD,
    REJECT_REASON,
    SOURCE_FILE,
    SourceError,
    parse_table,
    read_text_table,
)

ACCEPTED = "accepted"
OUTCOME = "outcome"


@dataclass(frozen=True)
class Targets:
    """Folders of one ingested table."""

    table: str
    quarantine: str
    audit: str

    @classmethod
    def under(cls, folder: str, name: str) -> Targets:
        folder = folder.rstrip("/")
        return cls(f"{folder}/{name}", f"{folder}/{name}_quarantine", f"{folder}/{name}_audit")


def landing(text: DataFrame, raw: Contract, rules: Sequence[Rule], key: str) -> DataFrame:
    """Parsed rows with key and outcome; rejected rows also keep the text they came as.

    A narrow projection of the scan: no shuffle and no Python.
    """
    rows = classify(parse_table(text, raw), rules)
    rejected = F.col(REJECT_REASON).isNotNull()
    return with_fingerprint(rows, raw.columns, key).select(
        key,
        *[exact(c) for c in raw.columns],
        F.when(rejected, F.col(RAW_RECORD)).alias(RAW_RECORD),
        F.when(rejected, F.col(SOURCE_FILE)).alias(SOURCE_FILE),
        F.coalesce(F.col(REJECT_REASON), F.lit(ACCEPTED)).alias(OUTCOME),
    )


def run_ingest(
    spark: SparkSession,
    source: str | list[str],
    targets: Targets,
    raw: Contract,
    stored: Contract,
    rules: Sequence[Rule],
    partition_by: str | None = None,
) -> LoadResult:
    """Load the accepted rows of ``source`` that ``targets.table`` lacks; the rest is set aside."""
    log = RunLog(spark, targets.audit)
    try:
        text = read_text_table(spark, source, raw)
    except (SourceError, ContractError) as error:
        log.fail("fetch" if isinstance(error, SourceError) else "validate", error)
        raise
    return load_text(text, str(source), targets, raw, stored, rules, log, partition_by)


def load_text(
    text: DataFrame,
    source: str,
    targets: Targets,
    raw: Contract,
    stored: Contract,
    rules: Sequence[Rule],
    log: RunLog,
    partition_by: str | None = None,
) -> LoadResult:
    """Gate and load rows read as text.

    The source is parsed once. Counts, quarantine and load read the landed table, so they describe
    the same rows even if the source changes meanwhile or a task is retried.
    """
    spark = text.sparkSession
    scratch = Scratch(spark)
    (key,) = stored.key
    try:
        landed = scratch.store(landing(text, raw, rules, key), "landing")
        valid = _report_gate(landed, source, targets, raw, log)
        batch = landed.filter(F.col(OUTCOME) == ACCEPTED).drop(OUTCOME, RAW_RECORD, SOURCE_FILE)
        result = insert_if_absent(spark, batch, targets.table, stored, partition_by, valid, log.run_id)
    except Exception as error:
        log.fail("load", error)
        raise
    finally:
        scratch.drop()
    log.add(
        "load",
        f"{result.rows_after - result.rows_before} of {valid} accepted rows are new; "
        f"the table grew from {result.rows_before} to {result.rows_after}",
        valid,
        result.rows_after - result.rows_before,
    )
    log.add("complete", f"finished with {result.rows_after} stored rows", None, result.rows_after)
    log.flush()
    return result


def quarantine_contract(raw: Contract) -> Contract:
    """One row per rejected record and source file, with the number of its copies there."""
    fields = (
        Field("record_key", "string"),
        *raw.fields,
        Field(RAW_RECORD, "string"),
        Field(REJECT_REASON, "string"),
        Field("source_file", "string"),
        Field("copies", "bigint"),
        Field("run_id", "string"),
    )
    return Contract(f"{raw.name}_quarantine", fields, key=("record_key",))


def _set_aside(landed: DataFrame, targets: Targets, raw: Contract, run_id: str) -> None:
    """Add rejected records to the quarantine, each once per source file however often it is loaded."""
    rejected = landed.filter(F.col(OUTCOME) != ACCEPTED)
    record_key = F.md5(F.to_json(F.struct(F.col(SOURCE_FILE), F.col(OUTCOME), F.col(RAW_RECORD))))
    # Copies have equal columns, as their text is the same; one of them stands for all.
    folded = rejected.withColumn("record_key", record_key).groupBy("record_key").agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.any_value(exact(c)).alias(c) for c in [*raw.columns, RAW_RECORD]],
        F.any_value(OUTCOME).alias(REJECT_REASON),
        F.any_value(SOURCE_FILE).alias("source_file"),
    )
    rows = folded.withColumn("run_id", F.lit(run_id))
    insert_if_absent(landed.sparkSession, rows, targets.quarantine, quarantine_contract(raw), run_id=run_id)


def _report_gate(landed: DataFrame, source: str, targets: Targets, raw: Contract, log: RunLog) -> int:
    """Log what the gate let through, set the rest aside, return the number of accepted rows."""
    per_outcome = landed.groupBy(OUTCOME).agg(F.count(F.lit(1)).alias("n"))
    counts = {r[OUTCOME]: r.n for r in per_outcome.collect()}  # one row per reason
    valid = counts.pop(ACCEPTED, 0)
    rejected = sum(counts.values())
    detail = ", ".join(f"{reason}: {n}" for reason, n in sorted(counts.items())) or "none"
    log.add("fetch", f"read {valid + rejected} rows from {source}", None, valid + rejected)
    log.add(
        "validate",
        f"{valid} rows accepted, {rejected} set aside ({detail})",
        valid + rejected,
        valid,
        rejected,
    )
    log.flush()
    if rejected:
        _set_aside(landed, targets, raw, log.run_id)
    return valid
