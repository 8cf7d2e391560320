"""Content fingerprint of a row: one canonical text per distinct row, then a digest of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import quoted
from ledgerstar.functions.cells import nan_to_null, same_value

DELIMITER = "|"
ESCAPE = "\\"
NULL_MARK = "\\N"

# Types whose text holds neither the delimiter nor the escape.
UNESCAPED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def canonical_cell(cell: str, data_type: T.DataType) -> str:
    """SQL for the text of a cell in which no delimiter is bare and NULL differs from every text."""
    text = f"CAST({cell} AS STRING)"
    if not isinstance(data_type, UNESCAPED):
        text = f"replace({text}, {_literal(ESCAPE)}, {_literal(ESCAPE * 2)})"
        text = f"replace({text}, {_literal(DELIMITER)}, {_literal(ESCAPE + DELIMITER)})"
    return f"coalesce({text}, {_literal(NULL_MARK)})"


def canonical_row(cells: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """One text per distinct row of SQL cells, built as one expression however many there are."""
    texts = ", ".join(canonical_cell(c, t) for c, t in zip(cells, types, strict=True))
    return F.expr(f"concat_ws({_literal(DELIMITER)}, {texts})")


def canonical_text(df: DataFrame, columns: Sequence[str]) -> Column:
    types = [df.schema[c].dataType for c in columns]
    cells = [nan_to_null(quoted(c), t) for c, t in zip(columns, types, strict=True)]
    return canonical_row(cells, types)


def row_identity(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Columns to group by when rows count as equal if ``columns`` are, NULLs and NaNs included.

    A few fixed-width columns are grouped as they are. Text or wide rows shrink to a 16-byte digest
    first, so that a shuffle does not carry them.
    """
    types = [df.schema[c].dataType for c in columns]
    cells = [same_value(quoted(c), t) for c, t in zip(columns, types, strict=True)]
    if len(columns) <= 4 and not any(isinstance(t, T.StringType) for t in types):
        return {f"_cell{i}": F.expr(cell) for i, cell in enumerate(cells)}
    return {"_digest": F.unhex(F.md5(canonical_row(cells, types)))}


def row_fingerprint(df: DataFrame, columns: Sequence[str], algorithm: str = "md5") -> Column:
    """Digest over exactly ``columns`` in that order, so extra or moved columns change no key."""
    text = canonical_text(df, columns)
    if algorithm == "md5":
        return F.md5(text)
    if algorithm == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"unknown digest {algorithm!r}")


def with_fingerprint(
    df: DataFrame, columns: Sequence[str], name: str = "row_hash", algorithm: str = "md5"
) -> DataFrame:
    return df.withColumn(name, row_fingerprint(df, columns, algorithm))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\") + "'"
