"""Table contracts: the columns, types and constraints a table must satisfy.

A contract drives the header check, the typed projection, the constraint checks and the exported
DDL. Parquet tables enforce none of PRIMARY KEY, UNIQUE, NOT NULL or REFERENCES, so the checks in
``operators.checks`` run them as jobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.session import exists, small_frame


class ContractError(ValueError):
    """A table does not satisfy its contract; nothing was written."""


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False


@dataclass(frozen=True)
class Reference:
    """``column`` must hold keys of ``table.key``."""

    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required or f.name in self.key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.DataType.fromDDL(f.type), True) for f in self.fields]
        )

    def missing_from(self, present: Iterable[str]) -> list[str]:
        """Contract columns absent from a header. Names compare exactly, unlike in Spark SQL."""
        held = set(present)
        return [name for name in self.columns if name not in held]

    def check_header(self, present: Sequence[str]) -> None:
        missing = self.missing_from(present)
        if missing:
            raise ContractError(f"{self.name}: the header lacks {', '.join(missing)}")

    def project(self, df: DataFrame, *extra: Column | str) -> DataFrame:
        """Contract columns, in contract order and by exact name, cast to their types."""
        self.check_header(df.columns)
        return df.select(*[exact(f.name).cast(f.type).alias(f.name) for f in self.fields], *extra)

    def ddl(self) -> str:
        """``CREATE TABLE`` text; constraints Parquet cannot hold are written as comments."""
        notes = {c: "primary key" for c in self.key}
        for group in self.unique:
            for c in group:
                notes[c] = "unique"
        for ref in self.references:
            notes[ref.column] = f"references {ref.table}({ref.key})"
        lines = []
        for f in self.fields:
            text = f"  {quoted(f.name)} {f.type.upper()}"
            if f.name in self.required:
                text += " NOT NULL"
            if f.name in notes:
                text += f" COMMENT '{notes[f.name]}'"
            lines.append(text)
        body = ",\n".join(lines)
        return f"CREATE TABLE IF NOT EXISTS {self.name} (\n{body}\n) USING PARQUET;"


def exact(name: str) -> Column:
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def export_ddl(spark: SparkSession, contracts: Sequence[Contract], path: str, *queries: str) -> str:
    """Write the DDL of ``contracts``, and any report queries, as one script and return its text."""
    text = "\n\n".join([c.ddl() for c in contracts] + [q.strip().rstrip(";") + ";" for q in queries])
    small_frame(spark, [(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def read_or_empty(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The table at ``path``, or an empty one with ``schema`` while nothing has been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else small_frame(spark, [], schema)
