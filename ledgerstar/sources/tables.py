"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` a relation that ``spark.sql`` can name."""
    df.createOrReplaceTempView(name)
    return df


def table_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)
