"""Star build, reconciliation and report on the twelve-row fixture."""

from __future__ import annotations

import os

import pytest
from conftest import F1
from pyspark.sql import functions as F

from ledgerstar.admissions import ADMISSIONS_STAR, EXPECTED_MEMBERS, RAW_ADMISSIONS
from ledgerstar.contracts import ContractError, export_ddl
from ledgerstar.operators import star as star_operators
from ledgerstar.operators.checks import require_valid, violations
from ledgerstar.operators.star import (
    Attribute,
    Dimension,
    Star,
    decode,
    label_counts,
    member_expectations,
    number_members,
    reconcile,
    unmatched_labels,
)
from ledgerstar.plans.marts import billing_by_condition_and_insurer
from ledgerstar.plans.star_build import StarTables, build_star, extend_star, stage_csv
from ledgerstar.sources.published import current_path
from ledgerstar.sources.tables import table_names

MART = [
    ("Asthma", "InsA", 4, 25000075.14, 100000300.55),
    ("Asthma", "InsB", 3, 133.47, 400.4),
    ("Diabetes", "InsB", 3, 66.77, 200.3),
    ("Diabetes", "InsA", 2, None, None),
]
MART_SQL = """
    SELECT c.condition_name, p.provider_name, count(*) AS admission_count,
           round(avg(f.billing_amount), 2) AS avg_billing,
           round(sum(f.billing_amount), 2) AS total_billing
    FROM fact_admissions f
    JOIN dim_medical_condition c USING (condition_id)
    JOIN dim_insurance_provider p USING (insurance_id)
    GROUP BY c.condition_name, p.provider_name
    ORDER BY c.condition_name NULLS LAST, total_billing DESC NULLS LAST
"""


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("star"))
    stage_csv(spark, str(F1), RAW_ADMISSIONS, f"{folder}/raw")
    return build_star(spark, f"{folder}/raw", ADMISSIONS_STAR, f"{folder}/star")


def test_blood_types_are_numbered_in_byte_order(star):
    rows = star.dimension("dim_blood_type").orderBy("blood_type_id").collect()
    assert [tuple(r) for r in rows] == list(
        enumerate(["A+", "A-", "AB+", "AB-", "B+", "B-", "O+", "O-"], start=1)
    )


def test_fact_has_every_raw_row_and_dense_ids(star):
    fact = star.fact()
    assert fact.columns == [f.name for f in ADMISSIONS_STAR.fact_contract.fields]
    assert sorted(r[0] for r in fact.select("admission_id").collect()) == list(range(1, 13))
    assert tuple(reconcile(star.raw(), fact).first()) == (12, 12, 0)


def test_ids_follow_the_rows_of_the_extract(star):
    names = [r.patient_name for r in star.fact().orderBy("admission_id").collect()]
    assert names == [r.Name for r in star.spark.read.csv(str(F1), header=True, escape='"').collect()]


def test_decoding_returns_the_raw_rows(star):
    decoded = decode(star.fact(), ADMISSIONS_STAR, star.dimensions())
    raw = star.raw().select(*[F.col(f"`{c}`") for c in decoded.columns])
    assert decoded.exceptAll(raw).count() == 0
    assert raw.exceptAll(decoded).count() == 0


def test_report(star):
    assert [tuple(r) for r in billing_by_condition_and_insurer(star).collect()] == MART


def test_report_as_sql_over_registered_tables(star):
    star.register("raw_admissions")
    assert {"raw_admissions", "fact_admissions", *EXPECTED_MEMBERS} <= set(table_names(star.spark))
    assert [tuple(r) for r in star.spark.sql(MART_SQL).collect()] == MART


def test_constraints_hold(star):
    rows = violations(star.tables(), ADMISSIONS_STAR.contracts).collect()
    assert len(rows) == 6 * 4 + 1 + 1 + 6
    assert all(r.n_violations == 0 for r in rows)


def test_broken_constraints_are_counted(star):
    tables = star.tables()
    fact = tables["fact_admissions"]
    tables["fact_admissions"] = fact.unionAll(fact.filter("admission_id = 1"))
    tables["dim_gender"] = tables["dim_gender"].filter("gender = 'Male'").unionAll(
        star.spark.createDataFrame([(2, "Male"), (None, None)], "gender_id int, gender string")
    )
    broken = {
        (r.table_name, r.rule, r.column_name): r.n_violations
        for r in violations(tables, ADMISSIONS_STAR.contracts).filter("n_violations > 0").collect()
    }
    female = fact.filter("gender_id = 1").count() + 1
    assert broken == {
        ("fact_admissions", "primary_key", "admission_id"): 1,
        ("dim_gender", "primary_key", "gender_id"): 1,
        ("dim_gender", "unique", "gender"): 1,
        ("dim_gender", "not_null", "gender_id"): 1,
        ("dim_gender", "not_null", "gender"): 1,
        ("fact_admissions", "references", "gender_id"): female,
    }
    with pytest.raises(ContractError, match="dim_gender"):
        require_valid(tables, ADMISSIONS_STAR.contracts)


def test_member_expectations(spark, star):
    status = {
        r.dim_name: (r.n_members, r.status)
        for r in member_expectations(spark, star.members(), {**EXPECTED_MEMBERS, "dim_none": 1}).collect()
    }
    assert status == {
        "dim_gender": (2, "OK"),
        "dim_blood_type": (8, "OK"),
        "dim_medical_condition": (2, "MISMATCH"),
        "dim_insurance_provider": (2, "MISMATCH"),
        "dim_admission_type": (3, "OK"),
        "dim_test_results": (3, "OK"),
        "dim_none": (0, "MISMATCH"),
    }


def test_labels_without_member_are_reported_and_refused(spark, star, folder):
    labels = label_counts(star.raw(), ADMISSIONS_STAR.dimensions)
    members = number_members(labels.filter("label <> 'Asthma'"))
    (lost,) = unmatched_labels(labels, members).collect()
    assert tuple(lost) == ("dim_medical_condition", "Asthma", 7)
    with pytest.raises(ContractError, match="7 rows match no member"):
        build_star(spark, star.raw_folder, ADMISSIONS_STAR, folder, members=members)
    assert not os.path.exists(f"{folder}/members")


@pytest.mark.parametrize("token", ["", "NA", "None"])
def test_missing_label_refuses_the_build(spark, folder, csv_file, f1_lines, token):
    source = csv_file([f1_lines[0], f1_lines[1].replace("Female", token), *f1_lines[2:]])
    stage_csv(spark, source, RAW_ADMISSIONS, f"{folder}/raw")
    with pytest.raises(ContractError, match="dim_gender: 1 rows have no label"):
        build_star(spark, f"{folder}/raw", ADMISSIONS_STAR, f"{folder}/star")
    assert not os.path.exists(f"{folder}/star")


def test_too_many_members_refuse_the_build(spark, star, folder):
    with pytest.raises(ContractError, match="dim_blood_type: 8 labels"):
        build_star(spark, star.raw_folder, ADMISSIONS_STAR, folder, max_members=7)


def test_members_too_many_for_one_task_get_the_same_ids(spark, star, folder, monkeypatch):
    monkeypatch.setattr(star_operators, "MAX_BROADCAST_MEMBERS", 1)
    other = build_star(spark, star.raw_folder, ADMISSIONS_STAR, folder)
    assert sorted(other.members().collect()) == sorted(star.members().collect())
    assert other.fact().exceptAll(star.fact()).count() == 0
    assert other.fact().count() == 12


def test_star_of_no_rows(spark, star, folder):
    star.raw().limit(0).write.parquet(f"{folder}/raw")
    empty = build_star(spark, f"{folder}/raw", ADMISSIONS_STAR, f"{folder}/star")
    assert all(df.count() == 0 for df in empty.tables().values())
    assert billing_by_condition_and_insurer(empty).count() == 0


def test_text_that_fits_no_type_stops_the_staging(spark, folder, csv_file, f1_lines):
    source = csv_file([f1_lines[0], f1_lines[1].replace("2024-01-02", "31/01/2024")])
    with pytest.raises(ContractError, match="1 rows do not fit"):
        stage_csv(spark, source, RAW_ADMISSIONS, f"{folder}/raw")


def test_refused_staging_and_build_leave_the_tables_as_they_were(spark, folder, csv_file, f1_lines):
    raw, star_folder = f"{folder}/raw", f"{folder}/star"
    stage_csv(spark, str(F1), RAW_ADMISSIONS, raw)
    built = build_star(spark, raw, ADMISSIONS_STAR, star_folder)
    wrong = csv_file([f1_lines[0], f1_lines[1].replace("2024-01-02", "31/01/2024")])
    with pytest.raises(ContractError, match="1 rows do not fit"):
        stage_csv(spark, wrong, RAW_ADMISSIONS, raw)
    assert spark.read.parquet(current_path(spark, raw)).count() == 12
    doubled = built.members().unionAll(
        spark.createDataFrame([("dim_gender", 1, "Other")], "dim_name string, id int, label string")
    )
    with pytest.raises(ContractError, match="dim_gender.gender_id: 1 x primary_key"):
        build_star(spark, raw, ADMISSIONS_STAR, star_folder, members=doubled)
    present = StarTables.present(spark, ADMISSIONS_STAR, star_folder, raw)
    assert present.folder == built.folder
    assert decode(present.fact(), ADMISSIONS_STAR, present.dimensions()).count() == 12
    assert sorted(p.split("-")[0] for p in os.listdir(star_folder)) == ["current", "version"]


def test_labels_of_other_types(spark, folder):
    rows = [(1, 101, "a"), (2, 102, "a"), (3, 101, "b")]
    spark.createDataFrame(rows, "n int, room int, ward string").write.parquet(f"{folder}/raw")
    model = Star(
        "fact_stays",
        "stay_id",
        (Attribute("n", "int", "n"), Dimension("dim_room", "room_id", "room", "room"), Dimension("dim_ward", "ward_id", "ward", "ward")),
    )
    built = build_star(spark, f"{folder}/raw", model, f"{folder}/star")
    assert sorted(map(tuple, decode(built.fact(), model, built.dimensions()).collect())) == [
        (n, str(room), ward) for n, room, ward in rows
    ]


def _staged(spark, folder, csv_file, header, lines, name):
    stage_csv(spark, csv_file([header, *lines], f"{name}.csv"), RAW_ADMISSIONS, f"{folder}/{name}")
    return current_path(spark, f"{folder}/{name}")


def test_extending_keeps_keys_and_facts(spark, folder, csv_file, f1_lines):
    header, *lines = f1_lines
    raw, added, more = (
        _staged(spark, folder, csv_file, header, part, name)
        for name, part in (("raw", lines[:4]), ("added", lines[4:9]), ("more", lines[9:]))
    )
    built = build_star(spark, raw, ADMISSIONS_STAR, f"{folder}/star")
    members = set(map(tuple, built.members().collect()))
    facts = {r[ADMISSIONS_STAR.fact_key]: r for r in built.fact().collect()}
    files = set(built.fact().inputFiles())
    for part in (added, more):
        star = extend_star(spark, part, ADMISSIONS_STAR, f"{folder}/star", raw)
        assert members <= set(map(tuple, star.members().collect()))
        assert files <= set(star.fact().inputFiles())
        members, files = set(map(tuple, star.members().collect())), set(star.fact().inputFiles())
    present = StarTables.present(spark, ADMISSIONS_STAR, f"{folder}/star", raw)
    held = {r[ADMISSIONS_STAR.fact_key]: r for r in present.fact().collect()}
    assert sorted(held) == list(range(1, 13)) and all(held[k] == r for k, r in facts.items())
    for d in ADMISSIONS_STAR.dimensions:  # ids stay dense
        assert sorted(r[0] for r in present.dimension(d.table).select(d.key).collect()) == list(range(1, present.dimension(d.table).count() + 1))
    decoded = decode(present.fact(), ADMISSIONS_STAR, present.dimensions())
    assert sorted(map(str, decoded.collect())) == sorted(map(str, present.raw().select(*decoded.columns).collect()))
    assert violations(present.tables(), ADMISSIONS_STAR.contracts).filter("n_violations > 0").count() == 0
    # A rebuild takes the place of all parts.
    rebuilt = build_star(spark, raw, ADMISSIONS_STAR, f"{folder}/star")
    assert StarTables.present(spark, ADMISSIONS_STAR, f"{folder}/star", raw).fact().count() == rebuilt.fact().count() == 4


def test_a_refused_extension_leaves_the_star(spark, folder, csv_file, f1_lines):
    header, *lines = f1_lines
    raw = _staged(spark, folder, csv_file, header, lines[:4], "raw")
    added = _staged(spark, folder, csv_file, header, [lines[4].replace("Male", "").replace("Female", "")], "added")
    build_star(spark, raw, ADMISSIONS_STAR, f"{folder}/star")
    with pytest.raises(ContractError, match="no label"):
        extend_star(spark, added, ADMISSIONS_STAR, f"{folder}/star", raw)
    assert StarTables.present(spark, ADMISSIONS_STAR, f"{folder}/star", raw).fact().count() == 4


def test_rebuild_is_a_no_op(spark, star, folder):
    build_star(spark, star.raw_folder, ADMISSIONS_STAR, folder)
    again = build_star(spark, star.raw_folder, ADMISSIONS_STAR, folder)
    for name, df in star.tables().items():
        other = again.tables()[name]
        assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0


def test_content_ids_do_not_depend_on_the_files(spark, star, folder):
    stars = []
    for n in (1, 5):
        star.raw().repartition(n).write.parquet(f"{folder}/raw{n}")
        stars.append(
            build_star(spark, f"{folder}/raw{n}", ADMISSIONS_STAR, f"{folder}/star{n}", ids_by_content=True)
        )
    first, second = [sorted(map(tuple, s.fact().collect()), key=str) for s in stars]
    assert first == second
    assert [r[0] for r in stars[0].fact().select("admission_id").orderBy("admission_id").collect()] == list(
        range(1, 13)
    )


def test_exported_ddl_runs_in_spark(spark, folder):
    text = export_ddl(spark, ADMISSIONS_STAR.contracts, f"{folder}/ddl", MART_SQL)
    stored = "\n".join(r.value for r in spark.read.text(f"{folder}/ddl", wholetext=True).collect())
    assert stored.strip() == text.strip()
    spark.sql("CREATE DATABASE IF NOT EXISTS ddl_check")
    spark.sql("USE ddl_check")
    try:
        for name in [*EXPECTED_MEMBERS, "fact_admissions"]:
            spark.catalog.dropTempView(name)
        for statement in text.split(";"):
            if statement.strip():
                spark.sql(statement)
        assert spark.table("fact_admissions").columns == ADMISSIONS_STAR.fact_contract.columns
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE ddl_check CASCADE")
