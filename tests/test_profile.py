"""Profile reports on the twelve-row fixture, and exact quantiles against NumPy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from conftest import F1
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerstar.admissions import RAW_ADMISSIONS
from ledgerstar.operators import profile, quantiles
from ledgerstar.sources.csv_table import parse_table, read_text_table
from ledgerstar.sources.tables import shape

DISTINCT = {
    "Name": 9,
    "Doctor": 4,
    "Hospital": 5,
    "Room Number": 8,
    "Gender": 2,
    "Blood Type": 8,
    "Medical Condition": 2,
    "Insurance Provider": 2,
    "Admission Type": 3,
    "Test Results": 3,
    "Age": 8,
    "Date of Admission": 8,
    "Billing Amount": 6,
    "Discharge Date": 8,
    "Medication": 2,
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = parse_table(read_text_table(spark, str(F1), RAW_ADMISSIONS), RAW_ADMISSIONS)
    return rows.select(*[F.col(f"`{c}`") for c in RAW_ADMISSIONS.columns]).cache()


def as_dict(df):
    return {r[0]: tuple(r)[1:] if len(r) > 2 else r[1] for r in df.collect()}


def test_shape_and_types(raw):
    assert shape(raw) == (12, 15)
    assert tuple(profile.table_shape(raw).first()) == (12, 15)
    types = dict(profile.column_types(raw))
    assert (types["Age"], types["Billing Amount"], types["Discharge Date"]) == ("int", "double", "date")


def test_nulls(spark, raw):
    nulls = as_dict(profile.null_counts(raw))
    assert nulls == {c: 2 if c == "Billing Amount" else 0 for c in RAW_ADMISSIONS.columns}
    frame = spark.createDataFrame([(float("nan"), "a"), (None, None), (1.0, "b")], "x double, y string")
    assert as_dict(profile.null_counts(frame)) == {"x": 2, "y": 1}


@pytest.mark.parametrize("approximate", [False, True])
def test_cardinality(raw, approximate):
    counts = as_dict(profile.distinct_counts(raw, None, approximate))
    assert counts == (pytest.approx(DISTINCT, abs=1) if approximate else DISTINCT)


def test_cardinality_of_every_type(spark):
    long_text = "x" * 100
    rows = [
        (1, 0.0, "a", True, "2024-01-01"),
        (2, -0.0, long_text + "1", False, "2024-01-02"),
        (2, float("nan"), long_text + "2", None, None),
        (None, None, None, True, "2024-01-01"),
    ]
    frame = spark.createDataFrame(rows, "i int, d double, s string, b boolean, t string").withColumns(
        {
            "day": F.to_date("t"),
            "stamp": F.to_timestamp("t"),
            "plain_stamp": F.to_timestamp_ntz("t"),
            "cents": F.col("i").cast("decimal(10,2)"),
            "f": F.col("d").cast("float"),
            "nothing": F.lit(None).cast("string"),
        }
    )
    assert as_dict(profile.distinct_counts(frame)) == {
        "i": 2, "d": 1, "s": 3, "b": 2, "t": 2, "day": 2, "stamp": 2, "plain_stamp": 2,
        "cents": 2, "f": 1, "nothing": 0,
    }


def test_duplicates(raw):
    assert tuple(profile.duplicate_rows(raw).first()) == (12, 2)
    assert tuple(profile.duplicate_rows(raw, fold=["Name"]).first()) == (12, 3)
    assert tuple(profile.hidden_duplicates(raw, fold=["Name"]).first()) == (2, 3, 1)


def test_duplicates_hold_equal_nulls_and_zeros_together(spark):
    rows = [(None, 0.0), (None, -0.0), (None, float("nan")), (None, None), ("", 0.0)]
    frame = spark.createDataFrame(rows, "s string, d double")
    assert tuple(profile.duplicate_rows(frame).first()) == (5, 2)
    assert tuple(profile.duplicate_rows(frame, ["d"]).first()) == (5, 3)
    assert tuple(profile.duplicate_rows(frame.limit(0)).first()) == (0, 0)


def test_numeric_summary(raw):
    summary = as_dict(quantiles.numeric_summary(raw, ["Billing Amount", "Age"]))
    assert summary["Billing Amount"] == pytest.approx(
        (10, 10000090.125, 31622745.02303, -50.0, 25.025, 100.1, 200.2, 100000000.25)
    )
    assert summary["Age"] == pytest.approx((12, 45.08333333, 12.80240, 29, 34, 41.5, 52, 70), rel=1e-5)


def test_categories_keep_a_missing_value(spark, raw):
    rows = profile.category_values(raw, ["Gender", "Test Results"]).collect()
    assert {tuple(r) for r in rows} == {
        ("Gender", "Female"),
        ("Gender", "Male"),
        ("Test Results", "Normal"),
        ("Test Results", "Abnormal"),
        ("Test Results", "Inconclusive"),
    }
    frame = spark.createDataFrame([("a",), (None,), ("a",)], "s string")
    assert {r.value for r in profile.category_values(frame, ["s"]).collect()} == {"a", None}


def test_case_variants(raw):
    rows = profile.case_variants(raw, ["Name", "Doctor", "Hospital"]).collect()
    assert [tuple(r) for r in rows] == [("Name", "ana ruiz", 2, 3)]


def test_dates_compare_to_the_time_of_day(spark):
    rows = [
        (1, "2024-01-02 14:00:00", "2024-01-02 08:00:00"),
        (2, "2024-01-02", "2024-01-02 00:00:01"),
        (3, "2024-01-02", "soon"),
        (4, None, "2024-01-02"),
    ]
    frame = spark.createDataFrame(rows, "i int, a string, b string")
    found = profile.dates_out_of_order(frame, "a", "b").select("i", "date_problem").collect()
    assert sorted(map(tuple, found)) == [(1, "out_of_order"), (3, "unparseable")]


def test_dates_out_of_order(raw):
    bad = profile.dates_out_of_order(raw, "Date of Admission", "Discharge Date")
    assert [r.Name for r in bad.collect()] == ["Gus Hale"]
    text = raw.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in ("Date of Admission", "Discharge Date")]
    )
    assert profile.dates_out_of_order(text, "Date of Admission", "Discharge Date").count() == 1


def test_dimension_candidates(raw):
    rows = profile.dimension_candidates(raw, raw.columns, max_members=3, max_ratio=0.3).collect()
    assert {r.column_name: r.n_distinct for r in rows} == DISTINCT
    assert {r.column_name for r in rows if r.is_dimension} == {
        "Gender",
        "Medical Condition",
        "Insurance Provider",
        "Admission Type",
        "Test Results",
        "Medication",
    }


def test_preview(raw):
    rows = profile.preview(raw, ["Name", "Doctor", "Hospital"], ["Room Number", "Doctor"], 3).collect()
    assert [r.Doctor for r in rows] == ["Kim Lee"] * 3
    assert rows[0].__fields__ == ["Name", "Doctor", "Hospital"]


def check_against_numpy(spark, values, sortable):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    row = quantiles.numeric_summary(frame, ["x"], sortable=sortable).first()
    data = np.array([v for v in values if v is not None and not math.isnan(v)])
    expected = np.quantile(data, [0.25, 0.5, 0.75])
    assert row.n == len(data)
    assert (row.q25, row.q50, row.q75) == pytest.approx(tuple(expected), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("sortable", [1, 5, 10_000])
@pytest.mark.parametrize(
    "values",
    [
        [float(i % 97) for i in range(1000)],
        [7.0] * 400 + [float(i) for i in range(800)],
        [1e308, -1e308, 0.0, 5e-324, 1e-300] * 3 + [float(i) for i in range(20)],
        [10.0**i for i in range(-300, 300, 7)],
        [1.0, None, float("nan"), 2.0],
        [3.0],
    ],
    ids=["spread", "one value fills a third", "extremes", "decades", "missing", "single"],
)
def test_quantiles_are_exact(spark, values, sortable):
    check_against_numpy(spark, values, sortable)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=32), st.just(1.5)),
        min_size=1,
        max_size=200,
    )
)
def test_quantiles_of_any_values(spark, values):
    check_against_numpy(spark, values, 2)


@pytest.fixture
def passes(monkeypatch):
    """Names of the steps that read the source after the first pass."""
    seen = []
    for name in ("_count", "_narrow"):
        step = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, step=step, name=name: seen.append(name) or step(*a))
    return seen


def test_quartiles_take_two_passes_whatever_the_spread(spark, passes):
    """560 decades, a tail of infinities, and the extremes that a range cannot span."""
    rng = np.random.default_rng(0)
    values = 10.0 ** rng.uniform(-280, 280, 60_000)
    values[:50], values[50:80], values[80:110] = -np.inf, -1.797e308, np.inf
    frame = spark.createDataFrame(pd.DataFrame({"x": values}))
    row = quantiles.numeric_summary(frame, sortable=100).first()
    assert (row.q25, row.q50, row.q75) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.75])), rel=1e-12)
    assert passes == ["_count"]  # and one for the measures and the sketch


def test_more_values_than_one_task_may_sort_take_two_more(spark, passes):
    values = np.random.default_rng(1).permutation(200_000).astype(float)
    frame = spark.createDataFrame(pd.DataFrame({"x": values, "y": values // 5000}))
    rows = as_dict(quantiles.numeric_summary(frame, sortable=50))
    assert rows["x"][4:7] == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    assert rows["y"][4:7] == tuple(np.quantile(values // 5000, [0.25, 0.5, 0.75]))
    assert passes == ["_count", "_narrow", "_count"]


def test_quartiles_at_a_hundred_million_rows_need_no_copy(spark, passes, monkeypatch):
    """What is written is the gathered values alone; the bracket of 10**8 rows is small enough to gather."""
    assert quantiles._likely(10**8) <= quantiles.SORTABLE_VALUES
    written = []
    store = quantiles.Scratch.store
    monkeypatch.setattr(quantiles.Scratch, "store", lambda self, df, name: written.append(store(self, df, name)) or written[-1])
    frame = spark.range(2_000_000).select(F.col("id").cast("double").alias("x"), F.lit("wide" * 50).alias("text"))
    monkeypatch.setattr(quantiles.Scratch, "drop", lambda self: None)
    row = quantiles.numeric_summary(frame).first()
    assert (row.q25, row.q50, row.q75) == (499_999.75, 999_999.5, 1_499_999.25)
    assert passes == ["_count"] and [w.count() < 6_000 for w in written] == [True]


def test_summary_covers_all_numeric_columns(spark):
    frame = spark.createDataFrame([(1, 2.0, "a", True)], "i int, d double, s string, b boolean")
    assert [r.column_name for r in quantiles.numeric_summary(frame).collect()] == ["i", "d"]


def test_quantiles_of_infinities_and_nothing(spark):
    infinite = [float("inf")] * 5 + [float("-inf")] * 5 + [float(i) for i in range(10)]
    frame = spark.createDataFrame([(v, None) for v in infinite], "x double, y double")
    rows = as_dict(quantiles.numeric_summary(frame, ["x", "y"], sortable=1))
    assert rows["x"][5] == 4.5
    assert rows["y"] == (0, None, None, None, None, None, None, None)
