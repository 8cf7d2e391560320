"""Constraint checks as jobs: primary key, unique, not null and references.

Each table is read once. A row gives one digest for every group of columns that some constraint looks
at; equal digests fold to a count inside each task before the shuffle, and NULLs of required columns are
counted on the way. References then meet the folded keys of their parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.contracts import Contract, ContractError, exact, quoted
from ledgerstar.functions.cells import same_value
from ledgerstar.functions.fingerprint import canonical_row
from ledgerstar.session import Scratch, small_frame

VIOLATIONS = "table_name string, rule string, column_name string, n_violations bigint"

Group = tuple[str, ...]


def violations(tables: Mapping[str, DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """(table_name, rule, column_name, n_violations), one row per declared constraint.

    Three jobs for any number of tables: fold all tables, sum up every group, and set the folded
    references against the folded keys they name.
    """
    spark = next(iter(tables.values())).sparkSession
    groups = {c.name: _groups(c, contracts) for c in contracts}
    checked = [c for c in contracts if groups[c.name] or c.required]
    if not checked:
        return small_frame(spark, [], VIOLATIONS)
    n_flags = max(len(c.required) for c in checked)
    scratch = Scratch(spark)
    try:
        parts = [_entries(tables[c.name], i, c, groups[c.name], n_flags) for i, c in enumerate(checked)]
        flags = [f"f{i}" for i in range(n_flags)]
        first = F.col("group_no") == 0
        folded = scratch.store(
            reduce(DataFrame.unionByName, parts)
            .groupBy("table_no", "group_no", "digest", "unset")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.when(first, F.col(f))).alias(f) for f in flags]),
            "folded",
        )
        sums = [F.sum(F.col("n") - 1).alias("spare"), *[F.sum(f).alias(f) for f in flags]]
        per_group = {
            (r.table_no, r.group_no): r for r in folded.groupBy("table_no", "group_no").agg(*sums).collect()
        }
        orphans = _orphans(folded, checked, groups)
    finally:
        scratch.drop()
    rows = [row for i, c in enumerate(checked) for row in _report(i, c, groups[c.name], per_group, orphans)]
    return small_frame(spark, rows, VIOLATIONS)


def require_valid(tables: Mapping[str, DataFrame], contracts: Sequence[Contract]) -> None:
    broken = violations(tables, contracts).filter("n_violations > 0").collect()  # one per rule
    if broken:
        raise ContractError(
            "; ".join(f"{b.table_name}.{b.column_name}: {b.n_violations} x {b.rule}" for b in broken)
        )


def _groups(contract: Contract, contracts: Sequence[Contract]) -> list[Group]:
    """Column groups whose values have to be folded, those that other tables refer to included."""
    own = [contract.key, *contract.unique, *[(r.column,) for r in contract.references]]
    asked = [(r.key,) for c in contracts for r in c.references if r.table == contract.name]
    return list(dict.fromkeys(tuple(g) for g in [*own, *asked] if g))


def _entries(df: DataFrame, number: int, contract: Contract, groups: Sequence[Group], n_flags: int) -> DataFrame:
    """(table_no, group_no, digest, unset, f0, f1, ...): one row for each row and group of a table.

    ``unset`` marks the value in which every column is NULL; the ``f`` columns mark the NULLs of the
    required columns. Numbers and dates stand for themselves, anything longer for its digest.
    """

    def digest(group: Group):
        types = [df.schema[c].dataType for c in group]
        cells = [same_value(quoted(c), t) for c, t in zip(group, types, strict=True)]
        text = canonical_row(cells, types)
        short = not any(isinstance(t, (T.StringType, T.BinaryType, T.ArrayType)) for t in types) and len(group) <= 4
        return text if short else F.md5(text)

    def entry(group_no: int, value, unset):
        return F.struct(F.lit(group_no).alias("group_no"), value.alias("digest"), unset.alias("unset"))

    entries = [] if groups else [entry(0, F.lit(""), F.lit(False))]
    for i, group in enumerate(groups):
        unset = F.coalesce(*[exact(c).cast("string") for c in group]).isNull()
        entries.append(entry(i, digest(group), unset))
    nulls = [exact(c).isNull().cast("bigint") for c in contract.required]
    nulls += [F.lit(0).cast("bigint")] * (n_flags - len(nulls))
    flags = [f"f{i}" for i in range(n_flags)]
    rows = df.select(F.explode(F.array(*entries)).alias("entry"), *[n.alias(f) for n, f in zip(nulls, flags, strict=True)])
    return rows.select(F.lit(number).alias("table_no"), "entry.*", *flags)


def _orphans(
    folded: DataFrame, checked: Sequence[Contract], groups: Mapping[str, list[Group]]
) -> dict[tuple[int, str], int]:
    """Rows per reference whose value no key of the parent has; NULLs refer to nothing."""
    place = {c.name: i for i, c in enumerate(checked)}
    children, parents, names = [], [], []
    for i, c in enumerate(checked):
        for ref in c.references:
            children.append((i, groups[c.name].index((ref.column,))))
            parents.append((place[ref.table], groups[ref.table].index((ref.key,))))
            names.append((i, ref.column))
    if not names:
        return {}

    def side(ends: list[tuple[int, int]]) -> DataFrame:
        """The folded rows of these groups, once for each reference they take part in."""
        numbers = [
            F.when((F.col("table_no") == t) & (F.col("group_no") == g), F.lit(i)) for i, (t, g) in enumerate(ends)
        ]
        return folded.select(F.explode(F.array_compact(F.array(*numbers))).alias("ref_no"), "digest", "unset", "n")

    lost = side(children).filter(~F.col("unset")).join(side(parents).select("ref_no", "digest"), ["ref_no", "digest"], "left_anti")
    return {names[r.ref_no]: r.n for r in lost.groupBy("ref_no").agg(F.sum("n").alias("n")).collect()}


def _report(number: int, contract: Contract, groups: list[Group], per_group, orphans) -> list[tuple]:
    name, rows = contract.name, []
    first = per_group.get((number, 0))
    for i, column in enumerate(contract.required):
        rows.append((name, "not_null", column, first[f"f{i}"] if first else 0))
    for rule, group in [("primary_key", contract.key), *[("unique", g) for g in contract.unique]]:
        if group:
            found = per_group.get((number, groups.index(tuple(group))))
            rows.append((name, rule, ",".join(group), found.spare if found else 0))
    rows += [(name, "references", r.column, orphans.get((number, r.column), 0)) for r in contract.references]
    return rows
