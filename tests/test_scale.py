"""Dense ids, loads under skew, and the plans that must hold at any size."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import REPO, SMALL
from pyspark.sql import functions as F

from ledgerstar.contracts import Contract, ContractError, Field
from ledgerstar.functions.fingerprint import with_fingerprint
from ledgerstar.operators import profile, upsert
from ledgerstar.operators.file_index import rows_per_run, undo_run
from ledgerstar.operators.ids import rows_without_dense_key, with_file_order_ids, with_ordered_ids
from ledgerstar.operators.star import label_counts, resolve_keys
from ledgerstar.operators.upsert import (
    absent_from,
    distinct_by_key,
    insert_if_absent,
    latest_per_key,
    read_keyed,
    replace_on_key,
)
from ledgerstar.plans import star_build
from ledgerstar.plans.marts import measure_by
from ledgerstar.plans.order_star import ORDER_STAR, build_order_star
from ledgerstar.plans.query_set import QUERIES
from ledgerstar.session import Scratch, names_in
from ledgerstar.sources.tables import table

PAIRS = Contract(
    "pairs", (Field("row_hash", "string"), Field("k", "int"), Field("v", "string")), ("row_hash",)
)
row_reconciliation = QUERIES["row_reconciliation"]
LATEST = Contract("latest", (Field("k", "int"), Field("seq", "int"), Field("v", "string")), ("k",))


@pytest.fixture(scope="module")
def star(spark):
    return build_order_star(spark, SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def pairs(spark, rows):
    return with_fingerprint(spark.createDataFrame(rows, "k int, v string"), ["k", "v"])


@pytest.mark.parametrize("files", [1, 3, 9])
def test_file_order_ids_are_dense(spark, folder, files):
    spark.range(1000).repartition(files).write.parquet(f"{folder}/t")
    ids = with_file_order_ids(spark, f"{folder}/t", "row_id")
    assert sorted(r.row_id for r in ids.collect()) == list(range(1, 1001))


def test_file_order_ids_survive_small_splits_and_appends(spark, folder):
    for start in (0, 500):
        spark.range(start, start + 500, 1, 3).write.mode("append").parquet(f"{folder}/t")
    whole = with_file_order_ids(spark, f"{folder}/t", "row_id").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = with_file_order_ids(spark, f"{folder}/t", "row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(whole) == sorted(split)
    assert sorted(r.row_id for r in whole) == list(range(1, 1001))


def test_ids_follow_the_files_of_a_task_past_their_padding(spark, folder):
    spark.range(2200).coalesce(1).write.option("maxRecordsPerFile", 2).parquet(f"{folder}/t")
    rows = with_file_order_ids(spark, f"{folder}/t", "row_id").collect()
    assert all(r.row_id == r.id + 1 for r in rows)


def test_ordered_ids_with_a_key_and_copies_filling_the_table(spark, folder):
    rows = [(1, "copy")] * 400 + [(1, f"v{i}") for i in range(300)] + [(i, "x") for i in range(2, 302)]
    spark.createDataFrame(rows, "k int, v string").repartition(4).write.parquet(f"{folder}/t")
    written = spark.read.parquet(f"{folder}/t")
    order = [F.col("k"), F.col("v")]
    scratch = Scratch(spark, folder)
    numbered = with_ordered_ids(written, order, scratch, "row_id").orderBy("row_id").collect()
    assert [r.row_id for r in numbered] == list(range(1, 1001))
    assert [(r.k, r.v) for r in numbered] == sorted(rows)


@pytest.mark.parametrize(
    ("ids", "lacking"),
    [
        ([], False), ([1], False), ([3, 1, 2], False), ([1, 1], True), ([2, 3], True), ([0, 1], True), ([1, None], True),
        # Equal count, least, greatest, sum and sum of squares, and still not each number once.
        ([2, 2, 3, 3, 4, 7, 7], True), ([1, 2, 2, 4, 6, 6, 7], True),
    ],
)
def test_dense_keys_are_proven(spark, ids, lacking):
    frame = spark.createDataFrame([(i,) for i in ids], "id int")
    assert bool(rows_without_dense_key(frame, "id")) == lacking


def test_proving_a_key_shuffles_no_row(spark, monkeypatch):
    """The only exchange gathers one row of sums from each task."""
    plans = []
    frame = type(spark.range(1))
    real = frame.agg
    monkeypatch.setattr(frame, "agg", lambda self, *a: plans.append(real(self, *a)) or plans[-1])
    assert rows_without_dense_key(spark.range(1, 100_001).repartition(9).select(F.col("id").alias("k")), "k") == 0
    assert len(plans) == 2
    for held in plans:
        assert "Exchange hashpartitioning" not in plan(held) and "partial_sum" in plan(held)


def test_a_fact_with_a_repeated_id_is_refused(spark, folder, monkeypatch):
    real = star_build.with_file_order_ids
    twice = lambda *a, **k: real(*a, **k).withColumn(ORDER_STAR.fact_key, F.greatest(F.col(ORDER_STAR.fact_key), F.lit(2).cast("bigint")))
    monkeypatch.setattr(star_build, "with_file_order_ids", twice)
    with pytest.raises(ContractError, match="lack a key"):
        build_order_star(spark, SMALL)


def test_numbering_rows_shuffles_none_of_them(spark, star):
    numbered = with_file_order_ids(spark, star.raw_folder, "order_id")
    fact = resolve_keys(numbered, ORDER_STAR, star.dimensions(), "inner", "order_id")
    text = plan(fact)
    assert text.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in text
    # The only exchanges are those of the per-file counts.
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange SinglePartition") == 1
    assert "ReadSchema: struct<>" in text


def test_report_groups_keys_before_it_decodes_them(star):
    report = measure_by(
        star, ("dim_nation", "dim_segment"), "order_price", "n", "avg", "total"
    )
    text = plan(report)
    assert text.index("BroadcastHashJoin") < text.index("HashAggregate")
    assert "ReadSchema: struct<nation_id:int,segment_id:int,order_price:double>" in text
    assert "partial_sum" in text


def test_label_scan_reads_labels_only_and_folds_first(star):
    text = plan(label_counts(star.raw(), ORDER_STAR.dimensions))
    assert "o_totalprice" not in text
    assert text.index("Exchange hashpartitioning") < text.index("partial_count")


def test_preview_never_sorts_the_table(spark):
    text = plan(profile.preview(table(spark, SMALL, "orders"), ["o_orderkey"], ["o_orderkey"], 5))
    assert "TakeOrderedAndProject" in text
    assert "Exchange" not in text


def test_large_batches_meet_the_target_in_one_shuffle_after_folding(spark, folder):
    stored = pairs(spark, [(i, "x") for i in range(50)])
    stored.write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(absent_from(stored, stored, "row_hash", 10, 50, max_broadcast=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert text.count("Exchange hashpartitioning(row_hash") == 2
    assert "partial_first" in text
    assert text.count("ReadSchema: struct<row_hash:string>") == 1


@pytest.mark.parametrize("max_broadcast", [0, 1000])
def test_both_ways_to_find_absent_rows_agree(spark, folder, max_broadcast):
    pairs(spark, [(i, "x") for i in range(100)]).write.parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    batch = pairs(spark, [(7, "copy")] * 200 + [(i, "x") for i in range(50, 150)])
    rows = absent_from(batch, stored, "row_hash", 300, 500, max_broadcast).collect()
    assert sorted((r.k, r.v) for r in rows) == sorted([(7, "copy")] + [(i, "x") for i in range(100, 150)])


def test_copies_fold_to_one_row(spark):
    batch = pairs(spark, [(1, "a")] * 500 + [(None, None)] * 500 + [(2, "a")])
    assert sorted(map(str, (r.k for r in distinct_by_key(batch, "row_hash").collect()))) == ["1", "2", "None"]


def test_insert_into_partitions_with_a_missing_value(spark, folder):
    path = f"{folder}/t"
    batch = pairs(spark, [(i, v) for i in range(10) for v in ("a", "b", None)])
    for expected in (30, 30):
        assert insert_if_absent(spark, batch, path, PAIRS, partition_by="v").rows_after == expected
    more = pairs(spark, [(1, None), (99, None), (1, "c")])
    assert insert_if_absent(spark, more, path, PAIRS, partition_by="v").rows_after == 32


def test_empty_batch_loads_nothing(spark, folder):
    batch = pairs(spark, [(1, "a")])
    insert_if_absent(spark, batch, f"{folder}/t", PAIRS)
    assert insert_if_absent(spark, batch.limit(0), f"{folder}/t", PAIRS).rows_after == 1
    assert insert_if_absent(spark, batch.limit(0), f"{folder}/u", PAIRS).rows_after == 0
    assert insert_if_absent(spark, batch, f"{folder}/u", PAIRS).rows_after == 1


def test_latest_per_key_is_decided_by_order_then_content(spark):
    rows = [(1, 1, "z"), (1, 2, "a"), (1, 2, "b"), (2, None, "n"), (2, 0, "m"), (None, 1, "q")]
    latest = latest_per_key(spark.createDataFrame(rows, LATEST.schema), ["k"], ["seq"])
    assert sorted(map(tuple, latest.collect()), key=str) == [(1, 2, "b"), (2, 0, "m"), (None, 1, "q")]
    assert "partial_max" in plan(latest)


def test_replace_on_key_keeps_other_rows_and_repeats(spark, folder):
    path = f"{folder}/t"
    first = spark.createDataFrame([(i, 1, "old") for i in range(100)], LATEST.schema)
    second = spark.createDataFrame([(5, 0, "new"), (5, 2, "newer"), (200, 1, "add")], LATEST.schema)
    assert replace_on_key(spark, first, path, LATEST, ["seq"], buckets=4).rows_after == 100
    for _ in range(2):
        assert replace_on_key(spark, second, path, LATEST, ["seq"], buckets=4).rows_after == 101
    rows = {r.k: r.v for r in read_keyed(spark, path, LATEST).collect()}
    assert rows == {**{i: "old" for i in range(100)}, 5: "newer", 200: "add"}


def _bucket_files(spark, path):
    return set(read_keyed(spark, path, LATEST).inputFiles())


def test_replace_on_key_rewrites_touched_buckets_only(spark, folder):
    path = f"{folder}/t"
    first = spark.createDataFrame([(i, 1, "old") for i in range(100)], LATEST.schema)
    replace_on_key(spark, first, path, LATEST, ["seq"], buckets=8)
    before = _bucket_files(spark, path)
    replace_on_key(spark, first.limit(1), path, LATEST, ["seq"], buckets=8)
    after = _bucket_files(spark, path)
    assert len(before) == 8 and len(before - after) == 1 and len(after - before) == 1


def test_a_load_killed_before_its_switch_loses_nothing(spark, folder, monkeypatch):
    path = f"{folder}/t"
    rows = lambda *r: spark.createDataFrame(list(r), LATEST.schema)
    held = lambda: sorted(tuple(r) for r in read_keyed(spark, path, LATEST).collect())
    replace_on_key(spark, rows(*[(i, 1, "old") for i in range(20)]), path, LATEST, ["seq"], buckets=3)
    before = held()
    for place in ("switch", "drop_versions"):
        with monkeypatch.context() as broken:
            target = upsert.Manifest if place == "switch" else upsert
            broken.setattr(target, place, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                replace_on_key(spark, rows((5, 2, place), (99, 1, place)), path, LATEST, ["seq"])
        if place == "switch":
            assert held() == before
    # Killed after the switch: the load is there as a whole.
    expected = sorted([r for r in before if r[0] != 5] + [(5, 2, "drop_versions"), (99, 1, "drop_versions")])
    assert held() == expected
    result = replace_on_key(spark, rows((5, 2, "drop_versions"), (99, 1, "drop_versions")), path, LATEST, ["seq"])
    assert held() == expected and result.rows_after == 21
    # What the dead loads left is gone: the folders there are those of the last two lists.
    assert len([n for n in names_in(spark, path) if n.startswith("version-")]) <= 4


def test_a_process_killed_in_its_commit_loses_nothing(spark, folder, tmp_path):
    """The process ends without a word between the written buckets and the switch."""
    path = f"{folder}/t"
    first = spark.createDataFrame([(i, 1, "old") for i in range(50)], LATEST.schema)
    replace_on_key(spark, first, path, LATEST, ["seq"], buckets=2)
    script = tmp_path / "killed.py"
    script.write_text(f"""
import os, sys
sys.path[:0] = [{str(REPO)!r}, {str(REPO / "tests")!r}]
from ledgerstar.operators import upsert
from ledgerstar.session import build_session
from test_scale import LATEST
spark = build_session("killed", "local[2]", spark__ui__enabled="false")
upsert.Manifest.switch = lambda *a: os._exit(9)
batch = spark.createDataFrame([(i, 2, "new") for i in range(50)], LATEST.schema)
upsert.replace_on_key(spark, batch, {path!r}, LATEST, ["seq"])
""")
    done = subprocess.run([sys.executable, str(script)], capture_output=True, timeout=300)
    assert done.returncode == 9
    assert {r.v for r in read_keyed(spark, path, LATEST).collect()} == {"old"}
    second = spark.createDataFrame([(i, 2, "new") for i in range(50)], LATEST.schema)
    assert replace_on_key(spark, second, path, LATEST, ["seq"]).rows_after == 50
    assert {r.v for r in read_keyed(spark, path, LATEST).collect()} == {"new"}


@pytest.fixture
def many_files(spark, folder):
    """A target of one file per shuffle partition."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    path = f"{folder}/t"
    insert_if_absent(spark, pairs(spark, [(i, "x") for i in range(4000)]), path, PAIRS, run_id="first")
    yield path
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_batch_is_looked_for_in_candidate_files_only(spark, many_files, monkeypatch):
    opened = []
    real = upsert.absent_from
    monkeypatch.setattr(upsert, "absent_from", lambda b, stored, *a: opened.append(stored.inputFiles()) or real(b, stored, *a))
    batch = pairs(spark, [(7, "x"), (8, "x"), (10**6, "x")])
    result = insert_if_absent(spark, batch, many_files, PAIRS, run_id="second")
    assert (result.rows_before, result.rows_after) == (4000, 4001)
    assert len(opened[0]) <= 3 < 64 <= len(names_in(spark, many_files))
    assert insert_if_absent(spark, batch, many_files, PAIRS).rows_after == 4001
    assert insert_if_absent(spark, pairs(spark, [(i, "x") for i in range(4000)]), many_files, PAIRS).rows_after == 4001
    assert spark.read.parquet(many_files).count() == 4001


def test_files_that_the_index_does_not_know_are_searched_and_recorded(spark, many_files, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(upsert.FileIndex, "record", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            insert_if_absent(spark, pairs(spark, [(10**6, "x")]), many_files, PAIRS, run_id="died")
    for _ in range(2):  # searched although unknown, and known afterwards
        result = insert_if_absent(spark, pairs(spark, [(10**6, "x"), (10**7, "x")]), many_files, PAIRS, run_id="next")
        assert result.rows_after == 4002
    index = upsert.FileIndex(spark, many_files, "row_hash", PAIRS.schema)
    assert index.held().unknown == () and index.count(index.held()) == 4002


def test_undoing_a_run_takes_its_rows_back(spark, many_files):
    insert_if_absent(spark, pairs(spark, [(i, "x") for i in range(3990, 4010)]), many_files, PAIRS, run_id="second")
    per_run = {r.run_id: r.n for r in rows_per_run(spark, many_files).groupBy("run_id").agg(F.sum("n_rows").alias("n")).collect()}
    assert per_run == {"first": 4000, "second": 10}
    assert undo_run(spark, many_files, "second") == 10
    assert undo_run(spark, many_files, "second") == 0
    assert spark.read.parquet(many_files).count() == 4000
    result = insert_if_absent(spark, pairs(spark, [(4005, "x")]), many_files, PAIRS, run_id="third")
    assert (result.rows_before, result.rows_after) == (4000, 4001)


def test_a_load_without_new_rows_leaves_no_file(spark, many_files):
    before = names_in(spark, many_files)
    insert_if_absent(spark, pairs(spark, [(1, "x")]), many_files, PAIRS)
    assert names_in(spark, many_files) == before


def test_replace_on_key_merges_in_more_tasks_than_buckets(spark, folder, monkeypatch):
    """Rows of two buckets are merged by key in all eight partitions."""
    path = f"{folder}/t"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    tasks = []
    chosen = upsert.latest_per_key
    monkeypatch.setattr(upsert, "latest_per_key", lambda *a: tasks.append(chosen(*a)) or tasks[-1])
    try:
        first = spark.createDataFrame([(i, 1, "old") for i in range(400)], LATEST.schema)
        replace_on_key(spark, first, path, LATEST, ["seq"], buckets=2)
        sizes = tasks[-1].groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_only_touched_partitions_are_searched(spark, folder):
    from ledgerstar.operators.upsert import _touched

    path = f"{folder}/t"
    rows = pairs(spark, [(i, v) for i in range(10) for v in ("a", "b", "c", "d")])
    insert_if_absent(spark, rows, path, PAIRS, partition_by="v")
    target = spark.read.schema(PAIRS.schema).parquet(path)
    touched = _touched(target, rows.filter("v in ('a', 'c')"), "v")
    assert "PartitionFilters: [v" in plan(touched)
    assert {p.split("v=")[1][0] for p in (r[0] for r in touched.select("_metadata.file_path").distinct().collect())} == {"a", "c"}


def test_reports_follow_changed_tables(spark, folder):
    for name in ("orders", "customer", "nation"):
        table(spark, SMALL, name).write.parquet(f"{folder}/{name}.parquet")
    count = lambda: row_reconciliation(spark, folder).first().fact_rows
    before = count()
    table(spark, SMALL, "orders").withColumn("o_orderkey", F.col("o_orderkey") + 10**9).write.mode("append").parquet(
        f"{folder}/orders.parquet"
    )
    assert count() == 2 * before


def test_average_in_cents_is_rounded_once(spark):
    from ledgerstar.plans.marts import _average_cents

    cents = [(1, 50.0, 10_001), (2, 0.01, 1), (3, -0.05, 2), (4, 0.05, 2)]
    rows = [(g, total if i == 0 else 0.0) for g, total, n in cents for i in range(n)]
    amount = F.col("v").cast("decimal(18,2)")
    frame = spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(_average_cents(amount).alias("a"))
    assert sorted(map(tuple, frame.collect())) == [(1, 0.0), (2, 0.01), (3, -0.03), (4, 0.03)]


def test_bucket_count_cannot_change(spark, folder):
    rows = spark.createDataFrame([(1, 1, "a")], LATEST.schema)
    replace_on_key(spark, rows, f"{folder}/t", LATEST, ["seq"], buckets=4)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        replace_on_key(spark, rows, f"{folder}/t", LATEST, ["seq"], buckets=8)


@pytest.mark.parametrize("partitions", [1, 7])
def test_reports_do_not_depend_on_partitioning(spark, partitions):
    parts = table(spark, SMALL, "lineitem").repartition(partitions)
    counts = {r.column_name: r.n_distinct for r in profile.distinct_counts(parts).collect()}
    assert counts["l_orderkey"] == table(spark, SMALL, "lineitem").select("l_orderkey").distinct().count()
    assert profile.duplicate_rows(parts).first().n_rows == 6000
