"""Star build: stage the raw table, number the dimensions, write the fact, check and register."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import Contract, ContractError, exact, read_or_empty
from ledgerstar.functions.fingerprint import row_fingerprint
from ledgerstar.operators.ids import rows_without_dense_key, with_file_order_ids, with_ordered_ids
from ledgerstar.operators.star import (
    Star,
    append_members,
    check_labels,
    label_counts,
    label_sizes,
    number_many_members,
    number_members,
    reconcile,
    resolve_keys,
    unmatched_labels,
)
from ledgerstar.session import Scratch
from ledgerstar.sources.csv_table import REJECT_REASON, parse_table, read_text_table
from ledgerstar.sources.published import NextVersion, Part, current_parts, current_path

MEMBER_SCHEMA = "id int, label string"


@dataclass(frozen=True)
class StarTables:
    """A written star: its folder, how to read it back, and the folders of facts that it only adds to."""

    spark: SparkSession
    star: Star
    folder: str
    raw_folder: str
    earlier: tuple[tuple[str, str], ...] = ()

    @classmethod
    def present(cls, spark: SparkSession, star: Star, folder: str, raw_folder: str) -> StarTables:
        """The star that the last finished build or extension left in ``folder``."""
        first = current_path(spark, raw_folder)
        parts = current_parts(spark, folder) or [Part("")]
        places = [(f"{folder.rstrip('/')}/{p.version}".rstrip("/"), p.source or first) for p in parts]
        return cls(spark, star, *places[0], tuple(places[1:]))

    def raw(self) -> DataFrame:
        return self.spark.read.parquet(self.raw_folder, *[raw for _, raw in self.earlier])

    def members(self) -> DataFrame:
        schema = f"{MEMBER_SCHEMA}, dim_name string"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/members").select(
            "dim_name", "id", "label"
        )

    def dimension(self, table: str) -> DataFrame:
        """Read from its own partition folder, so Spark sizes this dimension alone."""
        d = self.star.dimension(table)
        schema = T.DataType.fromDDL(MEMBER_SCHEMA)
        folder = f"{self.folder}/members/dim_name={table}"
        return read_or_empty(self.spark, schema, folder).toDF(d.key, d.label)

    def dimensions(self) -> dict[str, DataFrame]:
        return {d.table: self.dimension(d.table) for d in self.star.dimensions}

    def fact(self) -> DataFrame:
        schema = self.star.fact_contract.schema
        folders = [self.folder, *[folder for folder, _ in self.earlier]]
        return self.spark.read.schema(schema).parquet(*[f"{folder}/{self.star.fact}" for folder in folders])

    def tables(self) -> dict[str, DataFrame]:
        return {**self.dimensions(), self.star.fact: self.fact()}

    def register(self, raw_name: str) -> None:
        """Name every table for ``spark.sql``."""
        self.raw().createOrReplaceTempView(raw_name)
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def stage_csv(
    spark: SparkSession, source: str | list[str], contract: Contract, path: str
) -> DataFrame:
    """Publish the typed raw table, parsed in one pass over the source.

    No quality rule applies here, but a text that spells no value of its type stops the build, as
    it would stop a typed insert; the table that was there before then stays as it was.
    """
    rows = parse_table(read_text_table(spark, source, contract), contract)
    misfits = Observation("misfits")
    counted = rows.observe(misfits, F.count(REJECT_REASON).alias("n"))
    version = NextVersion(spark, path)
    try:
        counted.select(*[exact(c) for c in contract.columns]).write.parquet(version.path)
        if misfits.get["n"]:
            raise ContractError(f"{contract.name}: {misfits.get['n']} rows do not fit their types")
        version.switch()
    except Exception:
        version.discard()
        raise
    return spark.read.parquet(version.path)


def build_star(
    spark: SparkSession,
    raw_folder: str,
    star: Star,
    folder: str,
    members: DataFrame | None = None,
    ids_by_content: bool = False,
    max_members: int | None = None,
) -> StarTables:
    """Build every table of ``star`` from a written raw table and publish them together.

    All tables go to a version of their own, are checked there against their contracts and against the
    raw rows, and only then become the present star; a build that fails leaves the one before.

    One scan of the label columns gives the dimensions and the label checks. One scan of the rest
    writes the fact: the dimensions are broadcast into it and ids follow the raw rows' places, so
    no fact row is shuffled. ``ids_by_content`` pays one global sort to make ids independent of
    how the raw table is cut into files. ``members`` takes dimensions numbered elsewhere.
    """
    raw_path = current_path(spark, raw_folder)
    version = NextVersion(spark, folder)
    tables = StarTables(spark, star, version.path, raw_path)
    raw = spark.read.parquet(raw_path)
    scratch = Scratch(spark)
    try:
        labels = scratch.store(label_counts(raw, star.dimensions), "labels")
        sizes = label_sizes(labels)
        check_labels(sizes, max_members)
        if members is not None:
            _require_members(labels, members)
            sizes = label_sizes(members.withColumn("n_rows", F.lit(0)))
        elif all(size.broadcastable for size in sizes.values()):
            members = number_members(labels)
        else:
            members = number_many_members(labels, scratch)
        members.write.partitionBy("dim_name").parquet(f"{tables.folder}/members")
        # Before any fact row is joined: two members under one id would double rows.
        _check_members(tables)

        if ids_by_content:
            content = row_fingerprint(raw, [m.source for m in star.members])
            identified = with_ordered_ids(raw, [content], scratch, star.fact_key)
        else:
            identified = with_file_order_ids(spark, raw_path, star.fact_key, schema=raw.schema)
        dims = tables.dimensions()
        for name, size in sizes.items():
            if size.broadcastable:
                dims[name] = F.broadcast(dims[name])
        fact = resolve_keys(identified, star, dims, "inner", star.fact_key)
        fact.write.parquet(f"{tables.folder}/{star.fact}")
        counts = reconcile(raw, tables.fact()).first()
        if counts.difference:
            raise ContractError(f"{star.fact}: {counts.fact_rows} rows from {counts.raw_rows} raw rows")
        _check_fact(tables)
        version.switch()
    except Exception:
        version.discard()
        raise
    finally:
        scratch.drop()
    return tables


def extend_star(spark: SparkSession, added_folder: str, star: Star, folder: str, raw_folder: str) -> StarTables:
    """Add the rows of a written table to the present star of ``folder``.

    Members keep their ids; labels that are new get the ids after the greatest one, in label order. Facts
    that are there are neither read, but for their number, nor written: the new ones go to a version of
    their own, under ids that go on where the others end, and the switch names both. So the cost follows the
    rows that come. A failing extension leaves the star as it was. ``added_folder`` stays part of the raw table.
    """
    present = StarTables.present(spark, star, folder, raw_folder)
    version = NextVersion(spark, folder)
    places = ((present.folder, present.raw_folder), *present.earlier)
    added = spark.read.parquet(added_folder)
    only = StarTables(spark, star, version.path, added_folder)
    scratch = Scratch(spark)
    try:
        labels = scratch.store(label_counts(added, star.dimensions), "labels")
        check_labels(label_sizes(labels))
        members = scratch.store(append_members(labels, present.members()), "members")
        members.write.partitionBy("dim_name").parquet(f"{version.path}/members")
        _check_members(only)
        sizes = label_sizes(members.withColumn("n_rows", F.lit(0)))
        dims = only.dimensions()
        for name, size in sizes.items():
            if size.broadcastable:
                dims[name] = F.broadcast(dims[name])
        before = present.fact().count()
        identified = with_file_order_ids(spark, added_folder, star.fact_key, schema=added.schema)
        following = identified.withColumn(star.fact_key, exact(star.fact_key) + F.lit(before).cast("bigint"))
        resolve_keys(following, star, dims, "inner", star.fact_key).write.parquet(f"{version.path}/{star.fact}")
        counts = reconcile(added, only.fact()).first()
        if counts.difference:
            raise ContractError(f"{star.fact}: {counts.fact_rows} rows from {counts.raw_rows} raw rows")
        _check_fact(only, before)
        parts = current_parts(spark, folder) or [Part("", present.raw_folder)]
        earlier = [Part(p.version, p.source or raw) for p, (_, raw) in zip(parts, places, strict=True)]
        version.switch(source=added_folder, earlier=earlier)
    except Exception:
        version.discard()
        raise
    finally:
        scratch.drop()
    return StarTables(spark, star, version.path, added_folder, places)


def _check_members(tables: StarTables) -> None:
    """Every dimension's constraints, from one pass over the members."""
    measures = {
        "n": F.count(F.lit(1)),
        "ids": F.count("id"),
        "labels": F.count("label"),
        "distinct_ids": F.count_distinct("id"),
        "distinct_labels": F.count_distinct("label"),
    }
    counts = tables.members().groupBy("dim_name").agg(*[m.alias(name) for name, m in measures.items()])
    broken = []
    for r in counts.collect():  # one row per dimension
        d = tables.star.dimension(r.dim_name)
        found = (
            (d.key, "not_null", r.n - r.ids),
            (d.label, "not_null", r.n - r.labels),
            (d.key, "primary_key", r.ids - r.distinct_ids),
            (d.label, "unique", r.labels - r.distinct_labels),
        )
        broken += [f"{d.table}.{column}: {n} x {rule}" for column, rule, n in found if n]
    if broken:
        raise ContractError("; ".join(broken))


def _check_fact(tables: StarTables, before: int = 0) -> None:
    """The fact's own key, from ``before`` on. Its references hold as each row was joined to checked members."""
    key = tables.star.fact_key
    numbered = tables.fact().select((exact(key) - F.lit(before)).alias(key))
    lacking = rows_without_dense_key(numbered, key)
    if lacking:
        raise ContractError(f"{tables.star.fact}: {lacking} rows or more lack a key of their own")


def _require_members(labels: DataFrame, members: DataFrame) -> None:
    lost = unmatched_labels(labels, members).groupBy("dim_name").agg(F.sum("n_rows").alias("n"))
    found = lost.collect()  # one row per dimension
    if found:
        raise ContractError("; ".join(f"{r.dim_name}: {r.n} rows match no member" for r in found))
