"""Named queries: every operator applied to the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.contracts import Contract, ContractError, Field, exact, export_ddl
from ledgerstar.functions.fingerprint import with_fingerprint
from ledgerstar.operators import profile
from ledgerstar.operators.audit import AUDIT_SCHEMA, log_line
from ledgerstar.operators.checks import violations
from ledgerstar.operators.file_index import rows_per_run, undo_run
from ledgerstar.operators.ids import with_ordered_ids
from ledgerstar.operators.quality import (
    accepted,
    at_least_zero,
    classify,
    present,
    quarantined,
    summarize,
)
from ledgerstar.operators.quantiles import numeric_summary
from ledgerstar.operators.star import (
    decode,
    label_counts,
    label_sizes,
    member_expectations,
    number_many_members,
    number_members,
    reconcile,
    unmatched_labels,
)
from ledgerstar.operators.stored_profile import StoredProfile
from ledgerstar.operators.upsert import (
    distinct_by_key,
    insert_if_absent,
    read_keyed,
    replace_on_key,
)
from ledgerstar.plans.ingest import Targets, run_ingest
from ledgerstar.plans.marts import measure_by
from ledgerstar.plans.order_star import (
    CUSTOMER_EXTRACT,
    EXPECTED_ORDER_MEMBERS,
    LAST_ORDERS,
    ORDER_STAR,
    ORDERS,
    STORED_CUSTOMERS,
    STORED_DOCUMENTS,
    STORED_ORDERS,
    TABLE_CONTRACTS,
    build_order_star,
    flat_orders,
)
from ledgerstar.plans.star_build import StarTables, build_star, extend_star, stage_csv
from ledgerstar.session import Scratch, small_frame
from ledgerstar.sources.csv_table import SourceError, files_of, header_of, parse_table, read_text_table
from ledgerstar.sources.published import current_path
from ledgerstar.sources.tables import register, table, table_names
from ledgerstar.streaming.arrivals import ingest_arrivals

Query = Callable[[SparkSession, str], DataFrame]

Report = Callable[[StarTables], DataFrame]

QUERIES: dict[str, Query] = {}
REPORTS: dict[str, Report] = {}

BALANCE_RULES = (present("c_acctbal"), at_least_zero("c_acctbal"))
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LABEL_COLUMNS = ("o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name")
CANDIDATE_COLUMNS = (*LABEL_COLUMNS, "o_orderdate", "c_name")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Star and reports


def report(fn: Report) -> Report:
    """A report over a built star; the query of its name builds the star first."""
    REPORTS[fn.__name__] = fn
    QUERIES[fn.__name__] = lambda spark, folder: fn(build_order_star(spark, folder))
    return fn


@query
def star_build(spark, folder):
    """The whole build from the given tables, summarised by the rows of each table it wrote."""
    star = build_order_star(spark, folder)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in star.tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


@report
def mart_billing(star):
    return _billing(star)


@report
def mart_billing_exact(star):
    return _billing(star, exact_cents=True)


@report
def mart_sql(star):
    """The report as a user writes it against the registered tables."""
    star.register("raw_orders")
    return star.spark.sql("""
        SELECT n.nation_name, s.segment_name, count(*) AS order_count,
               round(avg(f.order_price), 2) AS avg_price,
               round(sum(f.order_price), 2) AS total_price
        FROM fact_orders f
        JOIN dim_nation n ON f.nation_id = n.nation_id
        JOIN dim_segment s ON f.segment_id = s.segment_id
        GROUP BY n.nation_name, s.segment_name
        ORDER BY n.nation_name NULLS LAST, total_price DESC NULLS LAST
    """)


@report
def star_dims(star):
    return star.members().select("dim_name", F.col("id").cast("int"), "label")


@report
def star_fact(star):
    return _portable(star.fact().drop(ORDER_STAR.fact_key))


@report
def fact_ids(star):
    ids = F.col(ORDER_STAR.fact_key)
    return star.fact().agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ids).alias("first_id"),
        F.max(ids).alias("last_id"),
        F.count_distinct(ids).alias("n_ids"),
    )


@report
def star_decode(star):
    return _portable(decode(star.fact(), ORDER_STAR, star.dimensions()))


@report
def star_constraints(star):
    """The declared constraints of the star's own tables."""
    return violations(star.tables(), ORDER_STAR.contracts)


@report
def unmatched_keys(star):
    """Labels of all orders against dimensions numbered before urgent and pending orders came in."""
    raw = star.raw()
    known = raw.filter((F.col("o_orderpriority") != "1-URGENT") & (F.col("o_orderstatus") != "P"))
    counts = label_counts(known, ORDER_STAR.dimensions)
    if all(size.broadcastable for size in label_sizes(counts).values()):
        members = number_members(counts)
    else:
        scratch = Scratch(star.spark)
        members = number_many_members(scratch.store(counts, "labels"), scratch)
    return unmatched_labels(label_counts(raw, ORDER_STAR.dimensions), members)


@query
def dense_ids(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return with_ordered_ids(orders, [F.col("o_orderkey")], Scratch(spark), "row_id")


@report
def row_reconciliation(star):
    return reconcile(star.raw(), star.fact())


@report
def dim_expectations(star):
    """Against the sizes the dimensions have, but for one that is wrong and one that is not there."""
    expected = {**EXPECTED_ORDER_MEMBERS, "dim_priority": 4, "dim_currency": 2}
    return member_expectations(star.spark, star.members(), expected)


@query
def constraint_checks(spark, folder):
    return violations({c.name: table(spark, folder, c.name) for c in TABLE_CONTRACTS}, TABLE_CONTRACTS)


# Quality gate


@query
def reject_negative(spark, folder):
    return accepted(_gated_customers(spark, folder)).select("c_custkey", "c_acctbal")


@query
def quarantine_rows(spark, folder):
    return quarantined(_gated_customers(spark, folder)).select(
        "c_custkey", "c_acctbal", "reject_reason"
    )


@query
def reject_summary(spark, folder):
    return summarize(_gated_customers(spark, folder))


@query
def csv_gate(spark, folder):
    """Customers written as text with faults and with line breaks in the first, a middle and the last
    column, read back under the contract and classified."""
    text = read_text_table(spark, _customer_extract(spark, folder, Scratch(spark)), CUSTOMER_EXTRACT)
    rows = classify(parse_table(text, CUSTOMER_EXTRACT), BALANCE_RULES)
    return rows.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "reject_reason")


# Fingerprint and load


@query
def row_fingerprint(spark, folder):
    return _keyed_orders(spark, folder).select("o_orderkey", "row_hash")


@query
def document_fingerprint(spark, folder):
    documents = table(spark, folder, "documents")
    return with_fingerprint(documents, ["text", "lang", "source"]).select("doc_id", "row_hash")


@query
def ingest_dedup(spark, folder):
    documents = table(spark, folder, "documents").select("text", "lang")
    return distinct_by_key(with_fingerprint(documents, ["text", "lang"]), "row_hash").select(
        "row_hash", "lang", F.length("text").alias("text_length")
    )


@query
def ingest_upsert(spark, folder):
    """All orders loaded over a table that already holds the early ones."""
    scratch = Scratch(spark)
    orders = scratch.store(_keyed_orders(spark, folder), "orders")
    target = scratch.path("target")
    insert_if_absent(spark, orders.filter("o_orderdate < DATE'1996-01-01'"), target, STORED_ORDERS)
    insert_if_absent(spark, orders, target, STORED_ORDERS)
    return _portable(spark.read.schema(STORED_ORDERS.schema).parquet(target))


@query
def ingest_partitioned(spark, folder):
    """All orders into a table laid out by priority, then one priority again, with its price raised."""
    scratch = Scratch(spark)
    orders = scratch.store(_keyed_orders(spark, folder), "orders")
    target = scratch.path("target")
    insert_if_absent(spark, orders, target, STORED_ORDERS, partition_by="o_orderpriority")
    urgent = ORDERS.project(orders.filter("o_orderpriority = '1-URGENT'"))
    raised = urgent.withColumn("o_totalprice", F.expr("CAST(o_totalprice + 1 AS DECIMAL(18,2))"))
    both = urgent.unionByName(raised.filter("o_orderkey % 2 = 0"))
    batch = scratch.store(with_fingerprint(both, ORDERS.columns), "batch")
    insert_if_absent(spark, batch, target, STORED_ORDERS, partition_by="o_orderpriority")
    return _portable(STORED_ORDERS.project(spark.read.parquet(target)))


def _two_loads(spark, folder):
    """A target that one run filled with the early orders, and a second one with all the others."""
    scratch = Scratch(spark)
    orders = scratch.store(_keyed_orders(spark, folder), "orders")
    target = scratch.path("target")
    insert_if_absent(spark, orders.filter("o_orderdate < DATE'1996-01-01'"), target, STORED_ORDERS, run_id="early")
    insert_if_absent(spark, orders, target, STORED_ORDERS, run_id="all")
    return target


@query
def star_extended(spark, folder):
    """Orders by nation and segment in a star that was built without one segment and half the nations and
    then extended by them, with the members whose key moved."""
    scratch = Scratch(spark)
    orders = scratch.store(flat_orders(spark, folder), "orders")
    first = (F.col("c_mktsegment") != "HOUSEHOLD") & (F.col("n_name") < "J")
    raw, added, built = scratch.path("raw"), scratch.path("added"), scratch.path("star")
    orders.filter(first).write.parquet(raw)
    orders.filter(~first).write.parquet(added)
    before = build_star(spark, raw, ORDER_STAR, built).members().withColumnRenamed("id", "old_id")
    star = extend_star(spark, added, ORDER_STAR, built, raw)
    moved = before.join(star.members(), ["dim_name", "label"], "left").filter("NOT old_id <=> id").count()
    return _billing(star).withColumn("moved_keys", F.lit(moved).cast("bigint"))


@query
def load_lineage(spark, folder):
    """Rows that each run brought, by the files it wrote, beside the rows that are in those files."""
    target = _two_loads(spark, folder)
    brought = rows_per_run(spark, target)
    held = spark.read.parquet(target).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    both = brought.join(held, "file", "left").groupBy("run_id")
    return both.agg(F.sum("n_rows").alias("n_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_held"))


@query
def load_undone(spark, folder):
    """Orders by priority after a second run was undone, with the rows that went."""
    target = _two_loads(spark, folder)
    gone = undo_run(spark, target, "all")
    held = spark.read.schema(STORED_ORDERS.schema).parquet(target)
    counts = held.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("rows_undone", F.lit(gone).cast("bigint"))


@query
def broken_lines(spark, folder):
    """Customers per nation from a file whose cells hold line breaks and quotes."""
    path = Scratch(spark).path("extract")
    customers = table(spark, folder, "customer")
    note = F.concat(F.col("c_name"), F.lit('\n"said"\n\n'), F.col("c_mktsegment"), F.lit(', 5" wide'))
    extract = customers.select(*[F.col(c).cast("string") for c in ("c_custkey", "c_nationkey")], note.alias("note"))
    extract.coalesce(1).write.options(header=True, quote='"', escape='"').csv(path)
    contract = Contract("notes", tuple(Field(c, "string") for c in ("c_custkey", "c_nationkey", "note")))
    rows = read_text_table(spark, path, contract)
    return rows.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.char_length("note")).alias("note_length"),
        F.max("note").alias("last_note"),
    )


@query
def stage_refused(spark, folder):
    """Rows of a staged table before and after a staging that its types refuse."""
    scratch = Scratch(spark)
    good, wrong, staged = scratch.path("good"), scratch.path("wrong"), scratch.path("staged")
    customers = table(spark, folder, "customer").select(*CUSTOMER_EXTRACT.columns)
    customers.write.csv(good, header=True)
    broken = F.concat(F.col("c_acctbal").cast("string"), F.lit(" USD"))
    customers.withColumn("c_acctbal", broken).write.csv(wrong, header=True)
    before = stage_csv(spark, good, CUSTOMER_EXTRACT, staged).count()
    refused = False
    try:
        stage_csv(spark, wrong, CUSTOMER_EXTRACT, staged)
    except ContractError:
        refused = True
    after = spark.read.parquet(current_path(spark, staged)).agg(
        F.count(F.lit(1)).alias("rows_after"), F.count("c_acctbal").alias("balances_after")
    )
    return after.select(F.lit(before).cast("bigint").alias("rows_before"), "*", F.lit(refused).alias("refused"))


@query
def quarantine_rerun(spark, folder):
    """Copies in quarantine per reason after two batch runs of one extract and two streams of another."""
    scratch = Scratch(spark)
    targets = Targets.under(scratch.root, "customers")
    batch, arrivals = (_customer_extract(spark, folder, Scratch(spark)) for _ in range(2))
    for _ in range(2):
        run_ingest(spark, batch, targets, CUSTOMER_EXTRACT, STORED_CUSTOMERS, BALANCE_RULES)
    for stream in ("first", "second"):
        loading = ingest_arrivals(
            spark, arrivals, targets, CUSTOMER_EXTRACT, STORED_CUSTOMERS, BALANCE_RULES, scratch.path(stream)
        )
        loading.awaitTermination()
    return spark.read.parquet(targets.quarantine).groupBy("reject_reason").agg(F.sum("copies").alias("n_rows"))


@query
def ingest_rerun(spark, folder):
    """Rows before and after loading one batch of documents, copies included, twice."""
    scratch = Scratch(spark)
    documents = table(spark, folder, "documents").select("text", "lang")
    batch = scratch.store(with_fingerprint(documents, ["text", "lang"]), "batch")
    target = scratch.path("target")
    runs = [insert_if_absent(spark, batch, target, STORED_DOCUMENTS) for _ in range(2)]
    rows = [(i, r.batch_rows, r.rows_before, r.rows_after) for i, r in enumerate(runs, start=1)]
    return small_frame(
        spark, rows, "run int, batch_rows bigint, rows_before bigint, rows_after bigint"
    )


@query
def upsert_replace(spark, folder):
    """Last order per customer of each batch: late orders first, then early ones, which replace them."""
    scratch = Scratch(spark)
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    for early in (False, True):
        batch = orders.filter((F.col("o_orderdate") < "1996-01-01") == F.lit(early))
        replace_on_key(
            spark, batch, scratch.path("target"), LAST_ORDERS, ["o_orderdate", "o_orderkey"], buckets=8
        )
    return _portable(read_keyed(spark, scratch.path("target"), LAST_ORDERS))


@query
def run_audit(spark, folder):
    """Run log of two ingests of the customer extract into one table, with its text lines.

    Counts a step lacks are 0; the extract's path, which no two runs share, is cut out of the text.
    """
    scratch = Scratch(spark)
    source = _customer_extract(spark, folder, scratch)
    targets = Targets.under(scratch.root, "customers")
    for _ in range(2):
        run_ingest(spark, source, targets, CUSTOMER_EXTRACT, STORED_CUSTOMERS, BALANCE_RULES)
    log = spark.read.schema(AUDIT_SCHEMA).parquet(targets.audit)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows_in", "rows_out", "rejected")]
    line = F.replace("line", F.lit(source), F.lit("the extract"))
    stamp = r"^\[\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\] "
    return log.select("step", *counts, "status", log_line().alias("line")).select(
        "step",
        "rows_in",
        "rows_out",
        "rejected",
        "status",
        F.regexp_replace(line, stamp, "").alias("message"),
        F.col("line").rlike(stamp).alias("stamped"),
    )


# Profile


@query
def profile_columns(spark, folder):
    shapes = [
        profile.table_shape(table(spark, folder, name)).withColumn("table_name", F.lit(name))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, shapes)


@query
def profile_nulls(spark, folder):
    orders = flat_orders(spark, folder).select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "n_name",
    )
    return profile.null_counts(orders)


@query
def profile_cardinality(spark, folder):
    return profile.distinct_counts(table(spark, folder, "lineitem"))


@query
def profile_grown(spark, folder):
    """Rows, missing cells and distinct values of every column of a table of events that grew by a load, with
    the distinct values before; each load is read once."""
    scratch = Scratch(spark)
    events = table(spark, folder, "events").withColumn("value", F.expr("CASE WHEN event_type <> 'click' THEN value END"))
    target = scratch.path("target")
    stored = StoredProfile(spark, target, scratch.path("profile"), events.schema)
    late = F.col("event_id") % 3 == 0
    events.filter(~late).write.parquet(target)
    before = stored.refresh().select("column_name", F.col("n_distinct").alias("n_distinct_before"))
    events.filter(late).write.mode("append").parquet(target)
    return stored.refresh().join(before, "column_name")


@query
def profile_grown_documents(spark, folder):
    """The same of documents, whose texts are long, in a table that is there and one load that repeats it."""
    scratch = Scratch(spark)
    documents = table(spark, folder, "documents")
    target = scratch.path("target")
    stored = StoredProfile(spark, target, scratch.path("profile"), documents.schema)
    documents.write.parquet(target)
    stored.refresh()
    documents.withColumn("doc_id", -F.col("doc_id") - 1).write.mode("append").parquet(target)
    return stored.refresh()


@query
def profile_duplicates(spark, folder):
    parts = {
        "documents": profile.duplicate_rows(table(spark, folder, "documents"), ["text", "lang"]),
        "lineitem": profile.duplicate_rows(
            table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
        ),
        "orders": profile.duplicate_rows(table(spark, folder, "orders")),
    }
    return reduce(
        DataFrame.unionByName, [df.withColumn("table_name", F.lit(n)) for n, df in parts.items()]
    )


@query
def profile_numeric(spark, folder):
    summary = numeric_summary(table(spark, folder, "lineitem"))
    rounded = [F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    return summary.select("column_name", "n", *rounded)


@query
def category_values(spark, folder):
    raw = flat_orders(spark, folder).withColumn(
        "o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))
    )
    return profile.category_values(raw, LABEL_COLUMNS)


@query
def dim_candidates(spark, folder):
    return profile.dimension_candidates(
        flat_orders(spark, folder), CANDIDATE_COLUMNS, max_members=100, max_ratio=0.05
    )


@query
def case_variants(spark, folder):
    return profile.case_variants(_respelled_parts(spark, folder), ["p_name", "p_brand"])


@query
def case_fold_duplicates(spark, folder):
    return profile.hidden_duplicates(
        _respelled_parts(spark, folder), fold=["p_name", "p_brand"], columns=["p_name", "p_brand"]
    )


@query
def date_logic(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    # Ordered at noon, shipped in the hour of the line's number; a fifth line's time is a bare word.
    shipped = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    timed = both.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(12))).alias("ordered_at"),
        F.when(F.col("l_linenumber") == 5, "soon")
        .otherwise(F.date_format(shipped, "yyyy-MM-dd HH:mm:ss"))
        .alias("shipped_at"),
    )
    problems = profile.dates_out_of_order(timed, "ordered_at", "shipped_at")
    return problems.select("l_orderkey", "l_linenumber", "shipped_at", "date_problem")


@query
def preview_topn(spark, folder):
    orders = table(spark, folder, "orders")
    return profile.preview(orders, ["o_orderkey", "o_orderpriority", "o_totalprice"], ["o_orderkey"], 10)


# Sources, catalog and DDL


@query
def source_files(spark, folder):
    """Rows in the listed files of an extract that was written in a folder per segment."""
    path = Scratch(spark).path("extract")
    table(spark, folder, "customer").write.partitionBy("c_mktsegment").csv(path, header=True)
    extract = spark.read.csv(path, header=True)
    listed = small_frame(spark, [(name.rsplit("/", 1)[1],) for name in files_of(extract)], "file string")
    file = F.element_at(F.split("_metadata.file_path", "/"), -1)
    held = extract.groupBy(file.alias("file"), F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    found = held.join(listed.distinct(), "file")
    return found.groupBy("segment").agg(F.sum("n_rows").alias("n_rows"))


@query
def source_refusals(spark, folder):
    """What the header check makes of the customers: as they are, one column short, one in capitals,
    and where there is no file."""
    scratch = Scratch(spark)
    customers = table(spark, folder, "customer").select(*CUSTOMER_EXTRACT.columns)
    cases = {
        "whole": customers,
        "column short": customers.drop("c_acctbal"),
        "other case": customers.withColumnRenamed("c_name", "C_NAME"),
        "no file": None,
    }
    rows = []
    for case, df in cases.items():
        path = scratch.path(case.replace(" ", "-"))
        if df is not None:
            df.write.csv(path, header=True)
        try:
            n_rows, outcome = read_text_table(spark, path, CUSTOMER_EXTRACT).count(), "read"
        except SourceError:
            n_rows, outcome = 0, "no source"
        except ContractError:
            lacking = CUSTOMER_EXTRACT.missing_from(header_of(spark, path))
            n_rows, outcome = 0, f"lacks {','.join(lacking)}"
        rows.append((case, outcome, n_rows))
    scratch.drop()
    return small_frame(spark, rows, "source_case string, outcome string, n_rows bigint")


@query
def table_catalog(spark, folder):
    """Every given table that the catalog lists, with its columns' types and its rows."""
    for name in TABLES:
        register(table(spark, folder, name), f"given_{name}")
    rows = []
    for name in [n.removeprefix("given_") for n in table_names(spark) if n.startswith("given_")]:
        df = spark.table(f"given_{name}")
        n_rows = df.count()
        rows += [(name, c, t, n_rows) for c, t in profile.column_types(df)]
    return small_frame(spark, rows, "table_name string, column_name string, type string, n_rows bigint")


@query
def ddl_lines(spark, folder):
    """The exported CREATE TABLE text of the given tables, their names written with blanks."""
    scratch = Scratch(spark)
    contracts = [
        Contract(name, tuple(Field(c.replace("_", " "), t) for c, t in table(spark, folder, name).dtypes))
        for name in TABLES
    ]
    export_ddl(spark, contracts, scratch.path("ddl"))
    return spark.read.text(scratch.path("ddl")).select(F.rtrim("value").alias("line")).filter("line <> ''")


@query
def blank_names(spark, folder):
    """Reports over customers whose column names hold blanks, dots and quotes."""
    renamed = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Segment.Name"),
        F.col("c_nationkey").alias("Nation `Key`"),
    )
    nulls = profile.null_counts(renamed)
    return nulls.join(profile.distinct_counts(renamed), "column_name")


# Parts


def _portable(df):
    """Dates as text and decimals as doubles, the forms that clients of both engines agree on."""
    forms = {"date": "string", "decimal": "double"}
    return df.select(
        *[exact(f.name).cast(forms.get(f.dataType.typeName(), f.dataType)).alias(f.name) for f in df.schema]
    )


def _billing(star, exact_cents=False):
    return measure_by(
        star,
        ("dim_nation", "dim_segment"),
        "order_price",
        "order_count",
        "avg_price",
        "total_price",
        exact_cents,
    )


def _gated_customers(spark, folder):
    """Customers of one segment come without a balance, half of them as NaN."""
    customers = table(spark, folder, "customer")
    unknown = F.when(F.col("c_nationkey") < 12, F.lit(float("nan")))
    balance = F.when(F.col("c_mktsegment") == "MACHINERY", unknown).otherwise(F.col("c_acctbal"))
    return classify(customers.withColumn("c_acctbal", balance), BALANCE_RULES)


def _customer_extract(spark, folder, scratch):
    """Write all customers as CSV text: missing marks, a wrong number and awkward characters."""
    balance = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "NA")
        .when(F.col("c_mktsegment") == "BUILDING", F.concat("c_acctbal", F.lit(" USD")))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    key = F.col("c_custkey").cast("string")
    key = F.when(F.col("c_nationkey") == 3, F.concat(F.lit("\n"), key)).otherwise(key)
    cut = F.when(F.col("c_nationkey") == 5, "\n").otherwise(", ")
    name = F.concat(F.col("c_name"), cut, F.lit('"a|b\\'), F.col("c_nationkey").cast("string"))
    segment = F.when(F.col("c_nationkey") == 7, F.concat("c_mktsegment", F.lit("\nplus"))).otherwise(
        F.col("c_mktsegment")
    )
    cells = {"c_custkey": key, "c_acctbal": balance, "c_name": name, "c_mktsegment": segment}
    path = scratch.path("extract")
    table(spark, folder, "customer").select(
        *[
            cells.get(c, exact(c)).cast("string").alias(c)
            for c in CUSTOMER_EXTRACT.columns
        ]
    ).write.options(header=True, quote='"', escape='"').csv(path)
    return path


def _keyed_orders(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return with_fingerprint(ORDERS.project(orders), ORDERS.columns)


def _respelled_parts(spark, folder):
    """All parts, the larger ones with their text in capitals."""
    capitals = F.col("p_size") > 25
    return table(spark, folder, "part").select(
        *[
            F.when(capitals, F.upper(c)).otherwise(F.col(c)).alias(c) if c in ("p_name", "p_brand") else c
            for c in ("p_partkey", "p_name", "p_brand", "p_size")
        ]
    )
