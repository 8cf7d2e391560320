"""Star model: dimensions with surrogate keys, a fact with resolved keys, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstar.contracts import Contract, ContractError, Field, Reference, exact
from ledgerstar.operators.ids import with_ordered_ids
from ledgerstar.session import Scratch, small_frame

# A dimension within both bounds takes less than 200 MB in an executor as a broadcast table.
MAX_BROADCAST_MEMBERS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Attribute:
    """A raw column kept in the fact under a new name and type."""

    name: str
    type: str
    source: str


@dataclass(frozen=True)
class Dimension:
    """A raw label column replaced in the fact by a small integer key."""

    table: str
    key: str
    label: str
    source: str

    @property
    def contract(self) -> Contract:
        return Contract(
            self.table,
            (Field(self.key, "int"), Field(self.label, "string", required=True)),
            key=(self.key,),
            unique=((self.label,),),
        )


@dataclass(frozen=True)
class Star:
    """Fact columns in order: attributes keep a value, dimensions become a key."""

    fact: str
    fact_key: str
    members: tuple[Attribute | Dimension, ...]

    @property
    def dimensions(self) -> list[Dimension]:
        return [m for m in self.members if isinstance(m, Dimension)]

    @property
    def attributes(self) -> list[Attribute]:
        return [m for m in self.members if isinstance(m, Attribute)]

    def dimension(self, table: str) -> Dimension:
        return next(d for d in self.dimensions if d.table == table)

    @property
    def fact_contract(self) -> Contract:
        fields = [Field(self.fact_key, "bigint")]
        fields += [
            Field(m.key, "int") if isinstance(m, Dimension) else Field(m.name, m.type)
            for m in self.members
        ]
        references = tuple(Reference(d.key, d.table, d.key) for d in self.dimensions)
        return Contract(self.fact, tuple(fields), key=(self.fact_key,), references=references)

    @property
    def contracts(self) -> list[Contract]:
        return [*[d.contract for d in self.dimensions], self.fact_contract]


def label_counts(raw: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """(dim_name, label, n_rows) for every label column in one scan, NULL labels included.

    Each task folds its rows to one count per label before anything is shuffled, so the shuffle
    grows with the number of labels and not with the number of rows, however skewed they are.
    """
    # Labels are text: columns of other types count by their text, here and where keys are resolved.
    pairs = [p for d in dimensions for p in (F.lit(d.table), exact(d.source).cast("string"))]
    stacked = raw.select(F.stack(F.lit(len(dimensions)), *pairs).alias("dim_name", "label"))
    return stacked.groupBy("dim_name", "label").agg(F.count(F.lit(1)).alias("n_rows"))


@dataclass(frozen=True)
class LabelSize:
    """What a dimension will hold, measured over its distinct labels."""

    members: int
    label_bytes: int
    rows_without: int

    @property
    def broadcastable(self) -> bool:
        return self.members <= MAX_BROADCAST_MEMBERS and self.label_bytes <= MAX_BROADCAST_BYTES


def label_sizes(labels: DataFrame) -> dict[str, LabelSize]:
    """Size per dimension, from ``label_counts``."""
    missing = F.when(F.col("label").isNull(), F.col("n_rows"))
    sizes = labels.groupBy("dim_name").agg(
        F.count("label").alias("members"),
        F.coalesce(F.sum(F.octet_length("label")), F.lit(0)).alias("label_bytes"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("rows_without"),
    )
    rows = sizes.collect()  # one row per dimension
    return {r.dim_name: LabelSize(r.members, r.label_bytes, r.rows_without) for r in rows}


def check_labels(sizes: Mapping[str, LabelSize], max_members: int | None = None) -> None:
    """Refuse a star before any write: a missing label has no member to refer to.

    ``max_members`` also refuses columns with more labels than a dimension is meant to have.
    """
    for name, size in sizes.items():
        if size.rows_without:
            raise ContractError(f"{name}: {size.rows_without} rows have no label")
        if max_members is not None and size.members > max_members:
            raise ContractError(
                f"{name}: {size.members} labels, more than {max_members}; "
                "keep this column as an attribute of the fact"
            )


def number_members(labels: DataFrame) -> DataFrame:
    """(dim_name, id, label): ids 1..n per dimension in label order, for few labels.

    One task numbers one dimension's distinct labels; ``number_many_members`` has no such task.
    """
    in_order = Window.partitionBy("dim_name").orderBy(F.col("label").asc_nulls_last())
    return labels.select("dim_name", F.row_number().over(in_order).alias("id"), "label")


def number_many_members(labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The same for any number of labels in a written table: sort them all, number by place."""
    order = [F.col("dim_name"), F.col("label")]
    placed = scratch.store(with_ordered_ids(labels, order, scratch, "place"), "placed")
    starts = placed.groupBy("dim_name").agg(F.min("place").alias("start"))  # one row per dimension
    return placed.join(F.broadcast(starts), "dim_name", "inner").select(
        "dim_name", (F.col("place") - F.col("start") + 1).cast("int").alias("id"), "label"
    )


def append_members(labels: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` as they are, and the labels they lack under the ids after each dimension's greatest.

    Only new labels are numbered, one task for a dimension's; the others are not touched.
    """
    fresh = number_members(unmatched_labels(labels.filter(F.col("label").isNotNull()), members))
    greatest = members.groupBy("dim_name").agg(F.max("id").alias("_greatest"))  # one row per dimension
    numbered = fresh.join(F.broadcast(greatest), "dim_name", "left").select(
        "dim_name", (F.col("id") + F.coalesce("_greatest", F.lit(0))).cast("int").alias("id"), "label"
    )
    return members.select("dim_name", "id", "label").unionByName(numbered)


def resolve_keys(
    raw: DataFrame, star: Star, dims: Mapping[str, DataFrame], how: str = "inner", *keep: str
) -> DataFrame:
    """Fact columns with each label replaced by its key; ``keep`` passes raw columns through.

    Dimensions that come with a broadcast hint, or that Spark's own size threshold admits, keep the
    chain of joins in the scan's stage. Others are joined by shuffle, where AQE splits hot labels.
    """
    out = raw
    for i, d in enumerate(star.dimensions):
        member = dims[d.table].select(
            F.col(d.key).alias(f"_key{i}"), F.col(d.label).alias(f"_label{i}")
        )
        out = out.join(member, exact(d.source).cast("string") == F.col(f"_label{i}"), how)
    keys = {d.table: F.col(f"_key{i}").alias(d.key) for i, d in enumerate(star.dimensions)}
    return out.select(
        *keep,
        *[
            keys[m.table]
            if isinstance(m, Dimension)
            else exact(m.source).cast(m.type).alias(m.name)
            for m in star.members
        ],
    )


def unmatched_labels(labels: DataFrame, members: DataFrame) -> DataFrame:
    """(dim_name, label, n_rows) of labels without a member: rows an inner join would drop.

    NULL labels never match and are always listed.
    """
    return labels.join(members, ["dim_name", "label"], "left_anti").select(
        "dim_name", "label", "n_rows"
    )


def decode(fact: DataFrame, star: Star, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The raw columns back from fact and dimensions."""
    out = fact
    for d in star.dimensions:
        out = out.join(dims[d.table].select(d.key, F.col(d.label).alias(f"_{d.table}")), d.key)
    return out.select(
        *[
            F.col(f"_{m.table}").alias(m.source)
            if isinstance(m, Dimension)
            else exact(m.name).alias(m.source)
            for m in star.members
        ]
    )


def reconcile(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """(raw_rows, fact_rows, difference) as one row."""
    none = F.lit(0).cast("bigint")
    counts = raw.agg(F.count(F.lit(1)).alias("raw_rows")).select("raw_rows", none.alias("fact_rows"))
    counts = counts.unionAll(fact.agg(none.alias("raw_rows"), F.count(F.lit(1)).alias("fact_rows")))
    return counts.agg(
        F.sum("raw_rows").alias("raw_rows"), F.sum("fact_rows").alias("fact_rows")
    ).select("raw_rows", "fact_rows", (F.col("raw_rows") - F.col("fact_rows")).alias("difference"))


def member_expectations(
    spark: SparkSession, members: DataFrame, expected: Mapping[str, int]
) -> DataFrame:
    """(dim_name, n_members, expected, status) with OK or MISMATCH, also for a missing dimension."""
    wanted = small_frame(spark, sorted(expected.items()), "dim_name string, expected bigint")
    found = members.groupBy("dim_name").agg(F.count(F.lit(1)).alias("n_members"))
    n_members = F.coalesce("n_members", F.lit(0))
    return wanted.join(found, "dim_name", "left").select(
        "dim_name",
        n_members.alias("n_members"),
        "expected",
        F.when(n_members == F.col("expected"), "OK").otherwise("MISMATCH").alias("status"),
    )

