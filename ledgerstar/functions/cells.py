"""Cell-level expressions: missing values, typed parsing, text folding. All run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that pandas' read_csv takes as missing when nothing else is configured.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

FLOATING = (T.DoubleType, T.FloatType)


def text_or_null(cell: str, missing: Sequence[str] = MISSING_TEXTS) -> str:
    """SQL for a text with missing marks as NULL; longer texts are not looked up."""
    texts = ", ".join("'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'" for text in missing)
    longest = max(len(text.encode()) for text in missing)
    return f"CASE WHEN octet_length({cell}) > {longest} OR {cell} NOT IN ({texts}) THEN {cell} END"


def is_missing(cell: Column, data_type: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    if isinstance(data_type, FLOATING):
        return cell.isNull() | F.isnan(cell)
    return cell.isNull()


def nan_to_null(cell: str, data_type: T.DataType) -> str:
    """SQL for ``cell`` with NaN as NULL."""
    if isinstance(data_type, FLOATING):
        return f"CASE WHEN NOT isnan({cell}) THEN {cell} END"
    return cell


def same_value(cell: str, data_type: T.DataType) -> str:
    """SQL under which equal values print equal: NaN joins NULL and -0.0 joins 0.0."""
    if isinstance(data_type, FLOATING):
        return f"CASE WHEN {cell} = 0 THEN 0.0D WHEN NOT isnan({cell}) THEN {cell} END"
    return cell


def parse(cell: str, type_name: str) -> str:
    """SQL for the typed value of a non-missing text; NULL when the text does not spell one exactly.

    Each test on the text's form runs only where a cheaper look at it leaves a doubt.
    """
    if type_name == "string":
        return cell
    value = f"try_cast({cell} AS {type_name})"
    if type_name in ("int", "bigint"):
        # "30.0" spells a whole number, "30.6" does not.
        return f"coalesce({value}, try_cast(regexp_replace(trim({cell}), '[.]0*$', '') AS {type_name}))"
    if type_name == "double":
        # Java accepts a trailing type letter ("1d"); a file does not mean a number by it.
        lettered = f"right(trim({cell}), 1) IN ('d', 'D', 'f', 'F') AND trim({cell}) RLIKE '[0-9.].$'"
        return f"CASE WHEN NOT ({lettered}) THEN {value} END"
    if type_name == "date":
        # Spark would also take a year, a year and month, or a date with a time.
        usual = f"length({cell}) = 10 AND substr({cell}, 5, 1) = '-' AND substr({cell}, 8, 1) = '-'"
        whole = f"trim({cell}) RLIKE '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$'"
        return f"CASE WHEN ({usual}) OR {whole} THEN {value} END"
    return value


def folded(cell: str) -> str:
    """SQL for a spelling with case and outer blanks ignored."""
    return f"lower(trim({cell}))"
