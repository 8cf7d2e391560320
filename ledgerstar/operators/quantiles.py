"""Exact numeric summaries of columns of any length, in two passes over the source for most.

Spark's exact ``percentile`` gathers every distinct value of a column in one task. Here one mergeable
sketch per column, taken in the same pass as the other measures, brackets each wanted rank by two values
between which it is sure to lie. The second pass counts what lies below and inside each bracket, and in the
same pass gathers what is inside, a few ten-thousandths of the rows, folded by value. Only where that would
still be too many values for one task, beyond some 10^8 rows, is a bracket cut again first, so even 10^12 rows
take four passes. Brackets are cut by rank and never by value: outliers, infinities and any spread of the
values cost nothing.

Every pass reads the columns it needs from the source itself, and nothing but the gathered values is
written. A frame whose plan is costly should be a written table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import exact
from ledgerstar.functions.cells import is_missing
from ledgerstar.session import Scratch, small_frame

QUARTILES = (0.25, 0.5, 0.75)
SUMMARY_SCHEMA = (
    "column_name string, n bigint, mean double, std double, min double, "
    "q25 double, q50 double, q75 double, max double"
)

# The sketch's rank error is one part in this; brackets reach three times as far on either side.
ACCURACY = 10_000
REACH = 3
# Values of one bracket that may meet in one task.
SORTABLE_VALUES = 100_000

Rank = tuple[str, int]


@dataclass(frozen=True)
class Bracket:
    """The ``n`` values of a column from ``low`` to ``high``; ``below`` others come before them.

    ``likely`` is how many values were to be expected before they were counted.
    """

    column: str
    low: float
    high: float
    n: int
    below: int = 0
    likely: int = field(default=0, compare=False)

    def inside(self) -> Column:
        return F.when(exact(self.column).between(self.low, self.high), exact(self.column))

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.n


def _likely(n: int) -> int:
    """Values in a bracket cut around a rank of ``n`` values."""
    return math.ceil(2 * REACH * n / ACCURACY) + 2


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, sortable: int = SORTABLE_VALUES
) -> DataFrame:
    """Count, mean, sample deviation, min, linear-interpolated quartiles and max per column.

    All numeric columns by default.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    scratch = Scratch(df.sparkSession)
    try:
        cells = {c: f"c{i}" for i, c in enumerate(names)}
        values = df.select(*[_number(df, c).alias(cells[c]) for c in names])
        rows = [(c, *_summary) for c, _summary in zip(names, _summaries(values, list(cells.values()), sortable, scratch), strict=True)]
    finally:
        scratch.drop()
    return small_frame(df.sparkSession, rows, SUMMARY_SCHEMA)


def _summaries(values: DataFrame, columns: list[str], sortable: int, scratch: Scratch) -> list[tuple]:
    around = [min(1.0, max(0.0, p + side * REACH / ACCURACY)) for p in QUARTILES for side in (-1, 1)]
    measures = (
        F.count,
        F.avg,
        F.stddev_samp,
        F.min,
        F.max,
        lambda c: F.approx_percentile(c, around, ACCURACY),
    )
    cells = [m(exact(c)).alias(f"m{i}_{c}") for c in columns for i, m in enumerate(measures)]
    if not cells:
        return []
    row = tuple(values.agg(*cells).first())
    stats = {c: row[i * len(measures) : (i + 1) * len(measures)] for i, c in enumerate(columns)}
    held = {
        (c, r): Bracket(c, sketch[2 * i], sketch[2 * i + 1], n, likely=_likely(n))
        for c, (n, _, _, _, _, sketch) in stats.items()
        for i, p in enumerate(QUARTILES)
        for r in (_ranks(p, n) if n else ())
    }
    wholes = {c: Bracket(c, low, high, n) for c, (n, _, _, low, high, _) in stats.items() if n}
    found = order_statistics(values, held, wholes, scratch, sortable)
    return [
        (n, mean, std, low, *[_interpolate(p, n, c, found) for p in QUARTILES], high)
        for c, (n, mean, std, low, high, _) in stats.items()
    ]


def order_statistics(
    values: DataFrame,
    held: dict[Rank, Bracket],
    wholes: dict[str, Bracket],
    scratch: Scratch,
    sortable: int = SORTABLE_VALUES,
) -> dict[Rank, float]:
    """Value at each (column, zero-based rank) of the columns' non-missing values.

    ``held`` gives a first bracket for each rank. Brackets are counted before they are believed; one that
    misses its rank gives way to the whole column, folded by value.
    """
    found: dict[Rank, float] = {}
    turn = 0
    while held:
        few = {b for b in held.values() if b.likely <= sortable and b.low < b.high}
        counted, gathered = _count(values, held, few, scratch, f"inside-{turn}")
        missed = {r: replace(wholes[r[0]], likely=0) for r, b in counted.items() if not b.holds(r[1])}
        sure = {r: b for r, b in counted.items() if r not in missed}
        found.update({r: b.low for r, b in sure.items() if b.low == b.high})
        found.update(_values_at(gathered, {r: sure[r] for r in sure if held[r] in few}, list(few), held))
        wide = {r: b for r, b in sure.items() if r not in found}
        held = {**missed, **(_narrow(values, wide) if wide else {})}
        turn += 1
    return found


def _count(
    values: DataFrame, held: dict[Rank, Bracket], few: set[Bracket], scratch: Scratch, name: str
) -> tuple[dict[Rank, Bracket], DataFrame | None]:
    """The brackets with how many values lie in and below each, and the values inside ``few`` of them.

    Both come from one pass: the counts are observed on the rows that the values are taken from.
    ``gathered`` has a row for each different value: ``bracket`` (its place in ``few``), ``value`` and ``n``.
    """
    brackets = list(dict.fromkeys(held.values()))
    cells = [
        cell
        for i, b in enumerate(brackets)
        for cell in (
            F.count_if(exact(b.column) < b.low).alias(f"below{i}"),
            F.count(b.inside()).alias(f"in{i}"),
        )
    ]
    gathered = None
    if few:
        counts = Observation(name)
        places = [cell for i, b in enumerate(few) for cell in (F.lit(i), b.inside())]
        any_inside = reduce(Column.__or__, [b.inside().isNotNull() for b in few])
        stacked = (
            values.observe(counts, *cells)
            .filter(any_inside)
            .select(F.stack(F.lit(len(few)), *places).alias("bracket", "value"))
        )
        folded = stacked.filter(F.col("value").isNotNull()).groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("n"))
        gathered = scratch.store(folded, name)
        row = counts.get
    else:
        row = values.agg(*cells).first().asDict()
    counted = {b: replace(b, n=row[f"in{i}"], below=row[f"below{i}"]) for i, b in enumerate(brackets)}
    return {rank: counted[b] for rank, b in held.items()}, gathered


def _narrow(values: DataFrame, held: dict[Rank, Bracket]) -> dict[Rank, Bracket]:
    """A closer bracket for each rank, from one sketch of each bracket's values."""
    ranks = list(held)
    cells = []
    for i, rank in enumerate(ranks):
        b = held[rank]
        at = (rank[1] - b.below + 0.5) / b.n
        around = [min(1.0, max(0.0, at + side * REACH / ACCURACY)) for side in (-1, 1)]
        cells.append(F.approx_percentile(b.inside(), around, ACCURACY).alias(f"q{i}"))
    row = values.agg(*cells).first()
    near = {}
    for i, r in enumerate(ranks):
        low, high = row[f"q{i}"]
        # Few different values: they fold to few rows, however many rows hold them.
        stuck = (low, high) == (held[r].low, held[r].high)
        near[r] = Bracket(r[0], low, high, held[r].n, held[r].below, 0 if stuck else _likely(held[r].n))
    return near


def _values_at(
    gathered: DataFrame | None, sure: dict[Rank, Bracket], few: list[Bracket], held: dict[Rank, Bracket]
) -> dict[Rank, float]:
    """The value of each rank, by one running sum over the gathered values of its bracket."""
    if not sure or gathered is None:
        return {}
    up_to = Window.partitionBy("bracket").orderBy(F.col("value").asc_nulls_last())
    running = gathered.withColumn("below", F.sum("n").over(up_to) - F.col("n"))
    places = {rank: (few.index(held[rank]), rank[1] - b.below) for rank, b in sure.items()}
    hit = F.lit(False)
    for index, place in set(places.values()):
        among = F.lit(place).between(F.col("below"), F.col("below") + F.col("n") - 1)
        hit = hit | ((F.col("bracket") == index) & among)
    rows = running.filter(hit).collect()  # at most one per rank
    return {
        rank: next(r.value for r in rows if r.bracket == index and r.below <= place < r.below + r.n)
        for rank, (index, place) in places.items()
    }


def _number(df: DataFrame, column: str) -> Column:
    cell = exact(column)
    return F.when(~is_missing(cell, df.schema[column].dataType), cell.cast("double"))


def _ranks(fraction: float, n: int) -> set[int]:
    at = fraction * (n - 1)
    return {math.floor(at), math.ceil(at)}


def _interpolate(fraction: float, n: int, column: str, found: dict[Rank, float]) -> float | None:
    if not n:
        return None
    at = fraction * (n - 1)
    low, high = found[column, math.floor(at)], found[column, math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))
