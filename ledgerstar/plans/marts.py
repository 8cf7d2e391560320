"""Reports over a star: aggregate the fact by key, then decode the few keys that remain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.contracts import exact
from ledgerstar.plans.star_build import StarTables


def measure_by(
    tables: StarTables,
    by: Sequence[str],
    measure: str,
    count_name: str,
    avg_name: str,
    total_name: str,
    exact_cents: bool = False,
) -> DataFrame:
    """Count, average and total of ``measure`` per combination of dimension labels.

    Grouping by the integer keys before the labels are joined gives the same groups, because a
    dimension holds each label once, and moves no text through the aggregation. Rows come sorted by
    the first label, then by descending total. ``exact_cents`` adds in DECIMAL(18,2), where the
    order of addition cannot matter, and rounds an average once, from the whole sum.
    """
    dimensions = [tables.star.dimension(name) for name in by]
    amount = exact(measure).cast("decimal(18,2)") if exact_cents else exact(measure)
    sums = tables.fact().groupBy(*[exact(d.key) for d in dimensions]).agg(
        F.count(F.lit(1)).alias(count_name),
        (_average_cents(amount) if exact_cents else _rounded(F.avg(amount))).alias(avg_name),
        _rounded(F.sum(amount)).alias(total_name),
    )
    for d in dimensions:
        sums = sums.join(tables.dimension(d.table), d.key, "inner")
    labels = [d.label for d in dimensions]
    return sums.select(*labels, count_name, avg_name, total_name).orderBy(
        F.col(labels[0]).asc_nulls_last(),
        F.col(total_name).desc_nulls_last(),
        *[F.col(label).asc_nulls_last() for label in labels[1:]],
    )


def billing_by_condition_and_insurer(tables: StarTables) -> DataFrame:
    """Admission count, average and total billing per medical condition and insurer."""
    return measure_by(
        tables,
        ("dim_medical_condition", "dim_insurance_provider"),
        "billing_amount",
        "admission_count",
        "avg_billing",
        "total_billing",
    )


def _average_cents(amount: Column) -> Column:
    """Sum over count, rounded half away from zero to cents, in whole numbers throughout."""
    cents = (F.sum(amount) * 100).cast("decimal(38,0)")
    n = F.count(amount).cast("decimal(19,0)")
    doubled = (F.abs(cents) * 2 + n).cast("decimal(38,0)")
    whole = F.call_function("div", doubled, n * 2)
    return F.when(n > 0, F.signum(cents) * whole / 100).cast("double")


def _rounded(value: Column) -> Column:
    return F.round(value.cast("double"), 2)
