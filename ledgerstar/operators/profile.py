"""Profile of a raw table. Every report is one aggregate whose result has a few rows per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import exact, quoted
from ledgerstar.functions.cells import FLOATING, folded, is_missing, same_value
from ledgerstar.functions.fingerprint import canonical_row, row_identity

# Longer texts travel as their SHA-256, which has exactly this many characters, so a shuffle of
# distinct long texts carries digests and no shorter plain value can be taken for one.
_DIGEST_LENGTH = 64

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def table_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_nulls): NULL and NaN cells of every column, counted in one pass."""
    names = list(columns or df.columns)
    counts = df.agg(
        *[
            F.count_if(is_missing(exact(c), df.schema[c].dataType)).alias(f"n{i}")
            for i, c in enumerate(names)
        ]
    )
    return _unpivot(counts, names, "n_nulls")


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """(column_name, n_distinct), missing values not counted.

    Exact by default: one scan, and tasks fold repeats before the shuffle. ``approximate`` keeps
    fixed-size sketches instead and shuffles nothing that grows with the data.
    """
    names = list(columns or df.columns)
    if approximate:
        sketches = df.agg(
            *[
                F.approx_count_distinct(F.expr(same_value(quoted(c), df.schema[c].dataType))).alias(
                    f"n{i}"
                )
                for i, c in enumerate(names)
            ]
        )
        return _unpivot(sketches, names, "n_distinct")
    cells, lanes = cells_by_type(df, names)
    values = cells.distinct()
    counts = values.groupBy("column_no").agg(F.count_if(any_present(lanes)).alias("n_distinct"))
    return counts.select(_name_of(names), "n_distinct")


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): every distinct value, a missing one included."""
    return _as_text(df, columns).distinct()


def duplicate_rows(
    df: DataFrame, columns: Sequence[str] | None = None, fold: Sequence[str] = ()
) -> DataFrame:
    """(n_rows, n_duplicates): rows after the first of their content, NULLs equal.

    Wide rows are reduced to a 16-byte digest before the shuffle, and equal rows fold inside each
    task, so neither long text nor one row repeated a billion times makes a large partition.
    Columns in ``fold`` compare without case and outer blanks.
    """
    names = list(columns or df.columns)
    if fold:
        df = df.withColumns({c: F.expr(folded(quoted(c))) for c in fold})
    identity = row_identity(df, names)
    per_row = df.groupBy(*[cell.alias(name) for name, cell in identity.items()]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_duplicates"),
    )


def hidden_duplicates(
    df: DataFrame, fold: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """(exact_duplicates, folded_duplicates, hidden_by_case) as one row.

    The digest of folded text is coarser than the plain one, so both counts come from one grouping:
    rows per (folded, plain) pair, then pairs per folded digest.
    """
    names = list(columns or df.columns)
    types = [df.schema[c].dataType for c in names]
    plain = [same_value(quoted(c), t) for c, t in zip(names, types, strict=True)]
    loose = [folded(cell) if c in fold else cell for c, cell in zip(names, plain, strict=True)]
    digests = df.select(
        F.unhex(F.md5(canonical_row(loose, types))).alias("loose"),
        F.unhex(F.md5(canonical_row(plain, types))).alias("plain"),
    )
    per_row = digests.groupBy("loose", "plain").agg(F.count(F.lit(1)).alias("n"))
    per_loose = per_row.groupBy("loose").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("spellings")
    )
    totals = per_loose.agg(
        F.coalesce(F.sum(F.col("n") - F.col("spellings")), F.lit(0)).alias("exact"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("folded"),
    )
    return totals.select(
        F.col("exact").cast("bigint").alias("exact_duplicates"),
        F.col("folded").cast("bigint").alias("folded_duplicates"),
        (F.col("folded") - F.col("exact")).cast("bigint").alias("hidden_by_case"),
    )


def case_variants(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, folded_value, n_spellings, n_rows) of values written in more than one way."""
    spellings = (
        _as_text(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_value = spellings.groupBy("column_name", F.expr(folded("value")).alias("folded_value")).agg(
        F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_rows")
    )
    return per_value.filter("n_spellings > 1")


def dates_out_of_order(df: DataFrame, start: str, end: str, problem: str = "date_problem") -> DataFrame:
    """Rows that end before they start, to the time of day, or whose dates are no dates.

    ``problem`` says which: ``out_of_order``, or ``unparseable`` for a text that spells no moment. A
    missing date is no problem.
    """
    moments = {c: _as_moment(df, c) for c in (start, end)}
    unread = [exact(c).isNotNull() & moments[c].isNull() for c in moments]
    found = F.when(unread[0] | unread[1], "unparseable").when(moments[end] < moments[start], "out_of_order")
    return df.withColumn(problem, found).filter(exact(problem).isNotNull())


def dimension_candidates(
    df: DataFrame, columns: Sequence[str], max_members: int, max_ratio: float
) -> DataFrame:
    """(column_name, n_distinct, distinct_ratio, is_dimension) from counts over the whole table."""
    cells, lanes = cells_by_type(df, columns)
    values = cells.groupBy("column_no", *lanes).agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("column_no").agg(
        F.count_if(any_present(lanes)).alias("n_distinct"), F.sum("n").alias("n_rows")
    )
    ratio = F.col("n_distinct") / F.col("n_rows")
    return counts.select(
        _name_of(columns),
        "n_distinct",
        ratio.alias("distinct_ratio"),
        ((F.col("n_distinct") <= max_members) & (ratio <= max_ratio)).alias("is_dimension"),
    )


def preview(df: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows along ``order_by``; each task keeps ``n`` rows, nothing is fully sorted."""
    keys = [exact(c).asc_nulls_last() for c in order_by]
    return df.orderBy(*keys).limit(n).select(*[exact(c) for c in columns])


def _unpivot(one_row: DataFrame, names: Sequence[str], measure: str) -> DataFrame:
    """Columns n0, n1, ... of a one-row frame as rows."""
    pairs = [p for i, c in enumerate(names) for p in (F.lit(c), F.col(f"n{i}"))]
    return one_row.select(F.stack(F.lit(len(names)), *pairs).alias("column_name", measure))


def _as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value) with one row per cell and values as text."""
    cells = []
    for c in columns:
        cells += [F.lit(c), F.expr(f"CAST({same_value(quoted(c), df.schema[c].dataType)} AS STRING)")]
    return df.select(F.stack(F.lit(len(columns)), *cells).alias("column_name", "value"))


def _lane(column: str, data_type: T.DataType) -> tuple[str, str]:
    """Name and SQL of the typed column that carries a cell's value unchanged, for grouping."""
    cell = quoted(column)
    if isinstance(data_type, WHOLE_NUMBERS):
        return "whole", f"CAST({cell} AS BIGINT)"
    if isinstance(data_type, FLOATING):
        return "real", f"CAST({same_value(cell, data_type)} AS DOUBLE)"
    if isinstance(data_type, (T.DateType, T.TimestampNTZType)):
        return "moment", f"CAST({cell} AS TIMESTAMP_NTZ)"
    text = f"CAST({cell} AS STRING)"
    return "text", f"CASE WHEN length({text}) < {_DIGEST_LENGTH} THEN {text} ELSE sha2({text}, 256) END"


def cells_by_type(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(column_no, lanes...) with one row per cell, its value in the lane of its type.

    Numbers and dates stay eight bytes wide: printing them first would cost more than grouping.
    """
    placed = [_lane(c, df.schema[c].dataType) for c in columns]
    lanes = list(dict.fromkeys(lane for lane, _ in placed))
    cells = []
    for i, (lane, value) in enumerate(placed):
        cells.append(str(i))
        cells += [value if lane == other else "NULL" for other in lanes]
    stack = f"stack({len(placed)}, {', '.join(cells)}) AS (column_no, {', '.join(lanes)})"
    return df.selectExpr(stack), lanes


def any_present(lanes: Sequence[str]) -> Column:
    return F.expr(" OR ".join(f"{lane} IS NOT NULL" for lane in lanes))


def _name_of(columns: Sequence[str]) -> Column:
    names = F.array(*[F.lit(c) for c in columns])
    return F.element_at(names, F.col("column_no") + 1).alias("column_name")


def _as_moment(df: DataFrame, column: str) -> Column:
    return exact(column).try_cast("timestamp")
