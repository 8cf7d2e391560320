"""Gate, fingerprint and idempotent load on the twelve-row fixture."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from conftest import F1
from pyspark.sql import functions as F

from ledgerstar.admissions import BILLING_RULES, INGESTED_ADMISSIONS, RAW_ADMISSIONS
from ledgerstar.contracts import Contract, ContractError, Field
from ledgerstar.functions.fingerprint import with_fingerprint
from ledgerstar.operators.audit import AUDIT_SCHEMA, log_lines
from ledgerstar.operators.quality import classify, summarize, validate
from ledgerstar.plans.ingest import Targets, landing, run_ingest
from ledgerstar.session import Scratch
from ledgerstar.sources.csv_table import (
    SourceError,
    _lines,
    files_of,
    files_with_broken_lines,
    parse_table,
    read_text_table,
)


def ingest(spark, source, targets, **options):
    return run_ingest(
        spark, source, targets, RAW_ADMISSIONS, INGESTED_ADMISSIONS, BILLING_RULES, **options
    )


def keys(spark, source):
    rows = landing(read_text_table(spark, source, RAW_ADMISSIONS), RAW_ADMISSIONS, BILLING_RULES, "row_hash")
    return {r.row_hash for r in rows.filter("outcome = 'accepted'").select("row_hash").collect()}


def typed(spark, source=str(F1)):
    return parse_table(read_text_table(spark, source, RAW_ADMISSIONS), RAW_ADMISSIONS)


def test_gate_counts(spark):
    valid, quarantine, summary = validate(typed(spark), BILLING_RULES)
    assert valid.count() == 8
    assert quarantine.count() == 4
    assert {r.outcome: r.n_rows for r in summary.collect()} == {
        "input": 12,
        "accepted": 8,
        "missing": 2,
        "negative": 2,
    }


def test_a_nan_is_missing_and_not_a_large_bill(spark):
    frame = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (-0.5,)], "`Billing Amount` double")
    reasons = [r.reject_reason for r in classify(frame, BILLING_RULES).collect()]
    assert reasons == ["missing", "missing", None, "negative"]


def test_first_and_second_run(spark, folder):
    targets = Targets.under(folder, "admissions")
    first = ingest(spark, str(F1), targets)
    second = ingest(spark, str(F1), targets)
    assert (first.rows_before, first.rows_after, first.batch_rows) == (0, 7, 8)
    assert (second.rows_before, second.rows_after) == (7, 7)
    stored = spark.read.parquet(targets.table)
    assert stored.columns == INGESTED_ADMISSIONS.columns
    assert stored.select("row_hash").distinct().count() == 7


def test_overlapping_second_batch(spark, folder, csv_file, f1_lines):
    targets = Targets.under(folder, "admissions")
    ingest(spark, str(F1), targets)
    new = f1_lines[6].replace("Cy Dahl", "Hal Ito")
    batch = csv_file([f1_lines[0], f1_lines[1], f1_lines[6], f1_lines[12], new])
    assert ingest(spark, batch, targets).rows_after == 8
    again = ingest(spark, batch, targets)
    assert (again.rows_before, again.rows_after) == (8, 8)


def test_load_laid_out_by_a_column(spark, folder, csv_file, f1_lines):
    targets = Targets.under(folder, "admissions")
    for expected in (7, 7):
        assert ingest(spark, str(F1), targets, partition_by="Admission Type").rows_after == expected
    new = f1_lines[6].replace("Cy Dahl", "Hal Ito").replace("Emergency", "Transfer")
    batch = csv_file([f1_lines[0], f1_lines[6], new])
    assert ingest(spark, batch, targets, partition_by="Admission Type").rows_after == 8


def test_quarantine_keeps_text_and_reason(spark, folder):
    targets = Targets.under(folder, "admissions")
    ingest(spark, str(F1), targets)
    rows = spark.read.parquet(targets.quarantine).collect()
    assert sorted((r.reject_reason, r.copies) for r in rows) == [("missing", 1), ("missing", 1), ("negative", 2)]
    assert sum('"Billing Amount":"-50.00"' in r.raw_record for r in rows) == 1
    assert sum('"Billing Amount":"NaN"' in r.raw_record for r in rows) == 1
    assert {Path(r.source_file).name for r in rows} == {F1.name}


def test_quarantine_neither_doubles_nor_vanishes(spark, folder, csv_file, f1_lines):
    targets = Targets.under(folder, "admissions")
    stored = lambda: spark.read.parquet(targets.quarantine).agg(F.sum("copies")).first()[0]
    for _ in range(2):
        ingest(spark, str(F1), targets)
        assert stored() == 4
    other = csv_file([f1_lines[0], f1_lines[4], f1_lines[7]])
    for _ in range(2):
        ingest(spark, other, targets)
        assert stored() == 6


def test_audit_rows_and_lines(spark, folder):
    targets = Targets.under(folder, "admissions")
    ingest(spark, str(F1), targets)
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit)
    steps = {r.step: (r.rows_in, r.rows_out, r.rejected, r.status) for r in audit.collect()}
    assert steps == {
        "fetch": (None, 12, None, "OK"),
        "validate": (12, 8, 4, "OK"),
        "load": (8, 7, None, "OK"),
        "complete": (None, 7, None, "OK"),
    }
    lines = [r.line for r in log_lines(audit).collect()]
    assert len(lines) == 4
    assert lines[1].endswith("8 rows accepted, 4 set aside (missing: 2, negative: 2)")
    assert lines[2].endswith("7 of 8 accepted rows are new; the table grew from 0 to 7")


def test_absent_source_is_logged_and_raised(spark, folder):
    targets = Targets.under(folder, "admissions")
    with pytest.raises(SourceError, match="nothing to read"):
        ingest(spark, f"{folder}/nowhere.csv", targets)
    (entry,) = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit).collect()
    assert (entry.step, entry.status) == ("fetch", "ERROR")
    assert not os.path.exists(targets.table)


@pytest.mark.parametrize(
    ("column", "replacement"), [("Medication", "Drug"), ("Gender", "gender")], ids=["absent", "other case"]
)
def test_missing_column_stops_the_run(spark, folder, csv_file, f1_lines, column, replacement):
    targets = Targets.under(folder, "admissions")
    source = csv_file([f1_lines[0].replace(column, replacement), *f1_lines[1:]])
    with pytest.raises(ContractError, match=column):
        ingest(spark, source, targets)
    assert not os.path.exists(targets.table)
    (entry,) = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit).collect()
    assert (entry.step, entry.status) == ("validate", "ERROR")


def test_extra_column_changes_no_key(spark, csv_file, f1_lines):
    source = csv_file([line + (",Note" if i == 0 else f",n{i}") for i, line in enumerate(f1_lines)])
    assert keys(spark, source) == keys(spark, str(F1))


def test_column_order_changes_no_key(spark, folder):
    text = read_text_table(spark, str(F1), RAW_ADMISSIONS)
    reordered = f"{folder}/reordered"
    text.select(*[F.col(f"`{c}`") for c in reversed(RAW_ADMISSIONS.columns)]).coalesce(1).write.option(
        "header", True
    ).option("escape", '"').csv(reordered)
    assert keys(spark, reordered) == keys(spark, str(F1))


def test_one_missing_age_leaves_other_keys(spark, csv_file, f1_lines):
    lines = list(f1_lines)
    lines[6] = lines[6].replace(",29,", ",,")
    changed, original = keys(spark, csv_file(lines)), keys(spark, str(F1))
    assert len(changed) == 7
    assert len(changed & original) == 6


def test_files_with_different_headers_fail(spark, csv_file, f1_lines):
    moved = f1_lines[0].replace("Name,Age", "Age,Name", 1)
    paths = [csv_file(f1_lines, "a.csv"), csv_file([moved, *f1_lines[1:]], "b.csv")]
    with pytest.raises(Exception, match="header does not conform"):
        read_text_table(spark, paths, RAW_ADMISSIONS).collect()


def test_failing_read_is_logged_and_leaves_no_table(spark, folder, csv_file, f1_lines):
    moved = f1_lines[0].replace("Name,Age", "Age,Name", 1)
    paths = [csv_file(f1_lines, "a.csv"), csv_file([moved, *f1_lines[1:]], "b.csv")]
    targets = Targets.under(folder, "admissions")
    with pytest.raises(Exception, match="header does not conform"):
        ingest(spark, paths, targets)
    (entry,) = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit).collect()
    assert (entry.step, entry.status) == ("load", "ERROR")
    assert not os.path.exists(targets.table)


@pytest.mark.parametrize(
    ("old", "new"),
    [
        ("2024-01-02", "31/01/2024"),
        ("2024-01-02", "2024-13-02"),
        ("2024-01-02", "2024-01-0x"),
        ("2024-01-05", "2024-01"),
        ("2024-01-05", "2024-01-05 10:00"),
        (",101,", ",30.6,"),
        (",34,", ",x,"),
        (",34,", ",99999999999,"),
        ("100.10", "1d"),
        ("100.10", "1.5 USD"),
    ],
)
def test_unparseable_text_is_set_aside(spark, csv_file, f1_lines, old, new):
    rows = typed(spark, csv_file([f1_lines[0], f1_lines[1].replace(old, new), f1_lines[2]]))
    assert {r.outcome: r.n_rows for r in summarize(classify(rows, BILLING_RULES)).collect()} == {
        "input": 2,
        "accepted": 1,
        "unparseable": 1,
    }


@pytest.mark.parametrize(
    ("old", "new", "column", "value"),
    [
        (",34,", ",34.0,", "Age", 34),
        (",34,", ", 34 ,", "Age", 34),
        ("100.10", "1.001e2", "Billing Amount", 100.1),
        ("100.10", "inf", "Billing Amount", float("inf")),
        ("2024-01-02", "2024-1-2", "Date of Admission", date(2024, 1, 2)),
        ("2024-01-02", " 2024-01-02", "Date of Admission", date(2024, 1, 2)),
        ("MedX", " MedX ", "Medication", " MedX "),
    ],
)
def test_other_spellings_of_a_value(spark, csv_file, f1_lines, old, new, column, value):
    row = typed(spark, csv_file([f1_lines[0], f1_lines[1].replace(old, new)])).first()
    assert (row[column], row.reject_reason) == (value, None)


def test_lines_with_a_wrong_field_count_are_set_aside(spark, csv_file, f1_lines):
    lines = [f1_lines[0], f1_lines[1], f1_lines[2] + ",more", "Ana Ruiz,34"]
    rows = classify(typed(spark, csv_file(lines)), BILLING_RULES)
    assert {r.outcome: r.n_rows for r in summarize(rows).collect()} == {
        "input": 3,
        "accepted": 1,
        "malformed": 2,
    }
    assert {r.raw_record for r in rows.filter("reject_reason = 'malformed'").collect()} == set(lines[2:])


@pytest.mark.parametrize(
    ("old", "new", "column", "value"),
    [
        ("Ana Ruiz", '"Ana\nRuiz Two"', "Name", "Ana\nRuiz Two"),
        ("North Clinic", '"North\nClinic ""A"""', "Hospital", 'North\nClinic "A"'),
        (",Normal", ',"Nor\nmal\n"', "Test Results", "Nor\nmal\n"),
    ],
    ids=["first", "middle", "last"],
)
def test_line_break_inside_quotes(spark, csv_file, f1_lines, old, new, column, value):
    paths = [
        csv_file([f1_lines[0], f1_lines[1].replace(old, new, 1), f1_lines[3]], "a.csv"),
        csv_file([f1_lines[0], *f1_lines[4:]], "b.csv"),
    ]
    rows = typed(spark, paths)
    assert rows.count() == 11
    assert rows.filter("reject_reason = 'malformed'").count() == 0
    assert rows.filter(F.col("Age") == 34).filter(F.col(f"`{column}`") == value).count() == 1
    # only the file with the break is read record by record
    assert [Path(r[0]).name for r in files_with_broken_lines(spark, paths).collect()] == ["a.csv"]


CELLS = ["a", "", '""', '"b"', '"c,d"', '"e\nf"', '"g ""h"" \n\n i"', '5" pipe', 'x"y', '"\n"', '"j""\n""k"', "  l ", '"m\r\nn"']


@pytest.mark.parametrize("seed", range(4))
def test_broken_files_of_any_range_size_read_like_whole_files(spark, tmp_path, seed):
    """Cells of every kind, in ranges of a few dozen bytes and more, against Spark's own whole-file reader."""
    rng = random.Random(seed)
    contract = Contract("t", tuple(Field(c, "string") for c in ("p q", "r", "s.t")))
    for name in ("a", "b"):
        lines = [",".join(rng.choice(CELLS) for _ in range(rng.choice([3, 3, 3, 3, 2, 4]))) for _ in range(120)]
        (tmp_path / f"{name}.csv").write_text("p q,r,s.t\n" + "\n".join(lines) + "\n", newline="")
    (tmp_path / "plain.csv").write_text("p q,r,s.t\n1,2,3\n")
    schema = "`p q` string, r string, `s.t` string, _malformed_line string"
    options = {"header": True, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": "_malformed_line"}
    whole = spark.read.schema(schema).options(**options, multiLine=True, columnPruning=False).csv(str(tmp_path))
    expected = Counter(map(str, whole.collect()))
    for size in ("40", "700", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            read = read_text_table(spark, str(tmp_path), contract).drop("_source_file")
            assert Counter(map(str, read.collect())) == expected
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_large_broken_file_is_many_tasks_work(spark, tmp_path):
    lines = [f'{i},"left\nright",{"x" * 80}' for i in range(20_000)]
    (tmp_path / "a.csv").write_text("i,two,pad\n" + "\n".join(lines) + "\n")
    contract = Contract("t", (Field("i", "string"), Field("two", "string")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        scanned = _lines(spark, str(tmp_path))
        assert scanned.rdd.getNumPartitions() > 15
        rows = read_text_table(spark, str(tmp_path), contract)
        text = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "a.csv" not in text.replace(str(tmp_path), "")  # files are met in a join, not listed
        assert rows.filter("two = 'left\nright'").count() == 20_000
        assert rows.select("i").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_broken_file_with_another_header_fails(spark, csv_file):
    paths = [csv_file(["a,b", "1,2"], "a.csv"), csv_file(["b,a", '"1\n",2'], "b.csv")]
    contract = Contract("t", (Field("a", "string"), Field("b", "string")))
    with pytest.raises(Exception, match="header"):
        read_text_table(spark, paths, contract).collect()


def test_an_open_quote_loads_no_part_of_a_record(spark, csv_file, f1_lines):
    source = csv_file([f1_lines[0], f1_lines[1], f1_lines[3].replace("North Clinic", '"North Clinic'), f1_lines[6]])
    rows = typed(spark, source)
    assert rows.filter("reject_reason is null").select("Name").collect() == [("Ana Ruiz",)]
    assert rows.filter("reject_reason = 'malformed'").count() == 1


@pytest.mark.parametrize("token", ["NA", "None", "null", "", "#N/A"])
def test_missing_texts(spark, csv_file, f1_lines, token):
    rows = typed(spark, csv_file([f1_lines[0], f1_lines[1].replace("Female", token)]))
    assert rows.first().Gender is None


def test_pipes_and_nulls_stay_apart(spark):
    pairs = [
        ("P|Q", "R"),
        ("P", "Q|R"),
        ("a", None),
        (None, "a"),
        ("a", "\\N"),
        ("P\\", "|R"),
        ("P\\|", "R"),
        ("", None),
    ]
    frame = with_fingerprint(spark.createDataFrame(pairs, "x string, y string"), ["x", "y"])
    assert frame.select("row_hash").distinct().count() == len(pairs)


def test_digests_agree_with_the_standard_library(spark):
    import hashlib

    row = with_fingerprint(spark.createDataFrame([("é|x", 3)], "x string, y int"), ["x", "y"]).first()
    assert row.row_hash == hashlib.md5("é\\|x|3".encode()).hexdigest()


def test_source_files_are_listed(spark):
    assert files_of(read_text_table(spark, str(F1), RAW_ADMISSIONS)) == [F1.as_uri()]


def test_scratch_uses_the_shared_folder_and_drops(spark):
    scratch = Scratch(spark)
    assert scratch.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch.store(spark.range(5), "five").count() == 5
    assert os.path.isdir(scratch.path("five"))
    scratch.drop()
    assert not os.path.isdir(scratch.root)
