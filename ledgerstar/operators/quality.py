"""Quality gate: rules name a reason to reject a row; every row ends up kept or in quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.contracts import exact
from ledgerstar.functions.cells import is_missing
from ledgerstar.sources.csv_table import REJECT_REASON


@dataclass(frozen=True)
class Rule:
    """``rejects`` builds, for a frame, the condition under which a row is refused."""

    reason: str
    rejects: Callable[[DataFrame], Column]


def present(column: str, reason: str = "missing") -> Rule:
    return Rule(reason, lambda df: is_missing(exact(column), df.schema[column].dataType))


def at_least_zero(column: str, reason: str = "negative") -> Rule:
    return Rule(reason, lambda df: exact(column) < 0)


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reason``: the one the row came with, else the first rule that refuses it."""
    reasons = [F.col(REJECT_REASON)] if REJECT_REASON in df.columns else []
    reasons += [F.when(rule.rejects(df), F.lit(rule.reason)) for rule in rules]
    return df.withColumn(REJECT_REASON, F.coalesce(*reasons, F.lit(None).cast("string")))


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(REJECT_REASON).isNotNull())


def validate(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows, quarantine with reasons, summary); the three share one classification."""
    classified = classify(df, rules)
    return accepted(classified), quarantined(classified), summarize(classified)


def summarize(classified: DataFrame) -> DataFrame:
    """(outcome, n_rows): one row per reject reason, ``accepted`` for the rest, ``input`` for all.

    Rows collapse to one count per reason inside each task, so the shuffle carries a few rows.
    """
    by_outcome = classified.groupBy(
        F.coalesce(F.col(REJECT_REASON), F.lit("accepted")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    # The total comes from the few counts, and is there even if there are none.
    total = by_outcome.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"))
    return by_outcome.unionByName(total.select(F.lit("input").alias("outcome"), "n_rows"))
