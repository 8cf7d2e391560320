"""Independent SQL, for another engine, of what each named query computes from the same tables."""

from __future__ import annotations

FLAT = """
flat AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, CAST(o.o_orderdate AS DATE) AS o_orderdate,
         o.o_orderpriority, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

DIMS = (
    ("dim_nation", "nation_id", "nation_name", "n_name"),
    ("dim_segment", "segment_id", "segment_name", "c_mktsegment"),
    ("dim_priority", "priority_id", "priority_name", "o_orderpriority"),
    ("dim_status", "status_id", "status_name", "o_orderstatus"),
)

DIM_CTES = ",".join(
    f"""
{name} AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY label) AS INTEGER) AS {key}, label AS {label}
  FROM (SELECT DISTINCT {source} AS label FROM flat)
)"""
    for name, key, label, source in DIMS
)


def _text(cell: str) -> str:
    """Canonical text of a cell: bare delimiters escaped, NULL marked."""
    escaped = f"replace(replace(CAST({cell} AS VARCHAR), '\\', '\\\\'), '|', '\\|')"
    return f"coalesce({escaped}, '\\N')"


def _digest(*cells: str) -> str:
    return f"md5(concat_ws('|', {', '.join(_text(c) for c in cells)}))"


ORDER_HASH = _digest(
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "CAST(o_totalprice AS DECIMAL(18,2))",
    "CAST(o_orderdate AS DATE)",
    "o_orderpriority",
)

BILLING = f"""
WITH {FLAT}
SELECT n_name AS nation_name, c_mktsegment AS segment_name, count(*) AS order_count,
       round(avg(o_totalprice), 2) AS avg_price, round(sum(o_totalprice), 2) AS total_price
FROM flat GROUP BY n_name, c_mktsegment
ORDER BY nation_name NULLS LAST, total_price DESC NULLS LAST"""

GATED = """
gated AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_mktsegment = 'MACHINERY' AND c_nationkey < 12 THEN CAST('NaN' AS DOUBLE)
              WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS shown,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'missing'
              WHEN c_acctbal < 0 THEN 'negative' END AS reject_reason
  FROM customer
)"""

EXTRACT = """
extract AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'missing'
              WHEN c_mktsegment = 'BUILDING' THEN 'unparseable'
              WHEN c_acctbal < 0 THEN 'negative' END AS reject_reason, *
  FROM customer
)"""

PARTS = """
parts AS (
  SELECT CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS p_name,
         CASE WHEN p_size > 25 THEN upper(p_brand) ELSE p_brand END AS p_brand
  FROM part
)"""


def _violation(table: str, rule: str, column: str, count_sql: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"CAST(({count_sql}) AS BIGINT) AS n_violations"
    )


def _nulls(table: str, column: str) -> str:
    return _violation(
        table, "not_null", column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    )


def _repeats(table: str, rule: str, columns: str) -> str:
    distinct = f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table})"
    return _violation(table, rule, columns, f"SELECT (SELECT count(*) FROM {table}) - ({distinct})")


def _orphans(table: str, column: str, parent: str, key: str) -> str:
    return _violation(
        table,
        "references",
        column,
        f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {key} FROM {parent})",
    )


def _none_broken(table: str, rule: str, column: str) -> str:
    return _violation(table, rule, column, "SELECT 0")


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _spark_type(type_name: str) -> str:
    names = (("BIGINT", "bigint"), ("INTEGER", "int"), ("VARCHAR", "string"), ("DOUBLE", "double"))
    cases = " ".join(f"WHEN '{theirs}' THEN '{ours}'" for theirs, ours in names)
    return f"CASE {type_name} {cases} ELSE CASE WHEN {type_name} LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' END END"


def _cells(relation: str, columns, cast: bool = True) -> str:
    value = "CAST({c} AS VARCHAR)" if cast else "{c}"
    return _union(
        f"SELECT '{c}' AS column_name, {value.format(c=c)} AS value FROM {relation}" for c in columns
    )


GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
LABELS = ("o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name")
LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

ORACLE_SQL: dict[str, str] = {
    "star_build": f"WITH {FLAT}\n"
    + _union(
        [
            "SELECT 'fact_orders' AS table_name, count(*) AS n_rows FROM flat",
            *[
                f"SELECT '{name}' AS table_name, count(DISTINCT {source}) AS n_rows FROM flat"
                for name, _, _, source in DIMS
            ],
        ]
    ),
    "star_constraints": _union(
        [
            *[_none_broken(name, rule, column) for name, key, label, _ in DIMS for rule, column in (
                ("not_null", key), ("not_null", label), ("primary_key", key), ("unique", label))],
            _none_broken("fact_orders", "not_null", "order_id"),
            _none_broken("fact_orders", "primary_key", "order_id"),
            *[_none_broken("fact_orders", "references", key) for _, key, _, _ in DIMS],
        ]
    ),
    "row_reconciliation": """
        SELECT count(*) AS raw_rows, count(*) AS fact_rows, CAST(0 AS BIGINT) AS difference
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "mart_billing": BILLING,
    "mart_sql": BILLING,
    "mart_billing_exact": f"""
        WITH {FLAT}
        SELECT n_name AS nation_name, c_mktsegment AS segment_name, count(*) AS order_count,
               CAST((2 * CAST(100 * sum(CAST(o_totalprice AS DECIMAL(18,2))) AS HUGEINT) + count(*))
                    // (2 * count(*)) AS DOUBLE) / 100 AS avg_price,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
        FROM flat GROUP BY n_name, c_mktsegment""",
    "star_dims": f"WITH {FLAT}, {DIM_CTES}\n"
    + _union(
        f"SELECT '{name}' AS dim_name, {key} AS id, {label} AS label FROM {name}"
        for name, key, label, _ in DIMS
    ),
    "star_fact": f"""
        WITH {FLAT}, {DIM_CTES}
        SELECT o_orderkey AS order_key, c_name AS customer_name, c_acctbal AS customer_balance,
               nation_id, segment_id, CAST(o_orderdate AS VARCHAR) AS order_date, priority_id, status_id,
               o_totalprice AS order_price
        FROM flat JOIN dim_nation ON n_name = nation_name
        JOIN dim_segment ON c_mktsegment = segment_name
        JOIN dim_priority ON o_orderpriority = priority_name
        JOIN dim_status ON o_orderstatus = status_name""",
    "star_decode": f"WITH {FLAT} SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM flat",
    "fact_ids": f"""
        WITH {FLAT}
        SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS n_ids
        FROM flat""",
    "unmatched_keys": f"""
        WITH {FLAT}, known AS (
          SELECT * FROM flat WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'
        )"""
    + _union(
        f"""
        SELECT '{name}' AS dim_name, {source} AS label, count(*) AS n_rows FROM flat
        WHERE {source} NOT IN (SELECT {source} FROM known) GROUP BY {source}"""
        for name, _, _, source in DIMS
    ),
    "dense_ids": """
        SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_id FROM orders""",
    "dim_expectations": f"WITH {FLAT}\n"
    + _union(
        f"""
        SELECT '{name}' AS dim_name, count(DISTINCT {source}) AS n_members,
               CAST({expected} AS BIGINT) AS expected,
               CASE WHEN count(DISTINCT {source}) = {expected} THEN 'OK' ELSE 'MISMATCH' END AS status
        FROM flat"""
        for (name, _, _, source), expected in zip(DIMS, (25, 5, 4, 3), strict=True)
    )
    + """
        UNION ALL
        SELECT 'dim_currency', CAST(0 AS BIGINT), CAST(2 AS BIGINT), 'MISMATCH'""",
    "constraint_checks": _union(
        [
            _nulls("nation", "n_nationkey"),
            _nulls("nation", "n_name"),
            _repeats("nation", "primary_key", "n_nationkey"),
            _nulls("customer", "c_custkey"),
            _nulls("customer", "c_name"),
            _repeats("customer", "primary_key", "c_custkey"),
            _repeats("customer", "unique", "c_name"),
            _orphans("customer", "c_nationkey", "nation", "n_nationkey"),
            _nulls("orders", "o_orderkey"),
            _nulls("orders", "o_custkey"),
            _repeats("orders", "primary_key", "o_orderkey"),
            _orphans("orders", "o_custkey", "customer", "c_custkey"),
            _nulls("lineitem", "l_orderkey"),
            _nulls("lineitem", "l_linenumber"),
            _repeats("lineitem", "primary_key", "l_orderkey,l_linenumber"),
            _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
            _nulls("documents", "doc_id"),
            _nulls("documents", "text"),
            _nulls("documents", "lang"),
            _repeats("documents", "primary_key", "doc_id"),
            _repeats("documents", "unique", "text,lang"),
        ]
    ),
    "reject_negative": f"""
        WITH {GATED} SELECT c_custkey, c_acctbal FROM gated WHERE reject_reason IS NULL""",
    "quarantine_rows": f"""
        WITH {GATED} SELECT c_custkey, shown AS c_acctbal, reject_reason FROM gated
        WHERE reject_reason IS NOT NULL""",
    "reject_summary": f"""
        WITH {GATED}
        SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n_rows FROM gated GROUP BY 1
        UNION ALL SELECT 'input', count(*) FROM gated""",
    "csv_gate": f"""
        WITH {EXTRACT}
        SELECT c_custkey,
               c_name || CASE WHEN c_nationkey = 5 THEN chr(10) ELSE ', ' END
                 || '"a|b\\' || CAST(c_nationkey AS VARCHAR) AS c_name,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN NULL ELSE c_acctbal END AS c_acctbal,
               c_mktsegment || CASE WHEN c_nationkey = 7 THEN chr(10) || 'plus' ELSE '' END AS c_mktsegment,
               reject_reason
        FROM extract""",
    "stage_refused": """
        SELECT count(*) AS rows_before, count(*) AS rows_after, count(c_acctbal) AS balances_after,
               true AS refused
        FROM customer""",
    "quarantine_rerun": f"""
        WITH {EXTRACT}
        SELECT reject_reason, CAST(2 * count(*) AS BIGINT) AS n_rows FROM extract
        WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "source_files": """
        SELECT c_mktsegment AS segment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment""",
    "source_refusals": """
        SELECT 'whole' AS source_case, 'read' AS outcome, count(*) AS n_rows FROM customer
        UNION ALL SELECT 'column short', 'lacks c_acctbal', 0
        UNION ALL SELECT 'other case', 'lacks c_name', 0
        UNION ALL SELECT 'no file', 'no source', 0""",
    "table_catalog": _union(
        f"""
        SELECT '{t}' AS table_name, column_name, {_spark_type("column_type")} AS type,
               (SELECT count(*) FROM {t}) AS n_rows
        FROM (DESCRIBE {t})"""
        for t in GIVEN
    ),
    "ddl_lines": _union(
        f"""
        SELECT 'CREATE TABLE IF NOT EXISTS {t} (' AS line
        UNION ALL
        SELECT '  `' || replace(column_name, '_', ' ') || '` ' || upper({_spark_type("column_type")})
               || CASE WHEN row_number() OVER () < count(*) OVER () THEN ',' ELSE '' END
        FROM (DESCRIBE {t})
        UNION ALL SELECT ') USING PARQUET;'"""
        for t in GIVEN
    ),
    "blank_names": """
        SELECT 'Customer Key' AS column_name, count(*) - count(c_custkey) AS n_nulls,
               count(DISTINCT c_custkey) AS n_distinct FROM customer
        UNION ALL
        SELECT 'Segment.Name', count(*) FILTER (WHERE c_mktsegment = 'BUILDING'),
               count(DISTINCT nullif(c_mktsegment, 'BUILDING')) FROM customer
        UNION ALL
        SELECT 'Nation `Key`', count(*) - count(c_nationkey), count(DISTINCT c_nationkey) FROM customer""",
    "ingest_partitioned": f"""
        WITH raised AS (
          SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
          WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 2 = 0
        ), stored AS (SELECT * FROM orders UNION ALL SELECT * FROM raised)
        SELECT DISTINCT {ORDER_HASH} AS row_hash, o_orderkey, o_custkey, o_orderstatus,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
        FROM stored""",
    "row_fingerprint": f"SELECT o_orderkey, {ORDER_HASH} AS row_hash FROM orders",
    "document_fingerprint": f"""
        SELECT doc_id, {_digest("text", "lang", "source")} AS row_hash FROM documents""",
    "ingest_dedup": f"""
        SELECT DISTINCT {_digest("text", "lang")} AS row_hash, lang,
               CAST(length(text) AS INTEGER) AS text_length
        FROM documents""",
    "ingest_upsert": f"""
        SELECT DISTINCT {ORDER_HASH} AS row_hash, o_orderkey, o_custkey, o_orderstatus,
               o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
        FROM orders""",
    "ingest_rerun": """
        WITH n AS (
          SELECT (SELECT count(*) FROM documents) AS batch_rows,
                 (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS stored
        )
        SELECT CAST(1 AS INTEGER) AS run, batch_rows, CAST(0 AS BIGINT) AS rows_before,
               stored AS rows_after FROM n
        UNION ALL SELECT 2, batch_rows, stored, stored FROM n""",
    "star_extended": f"SELECT *, CAST(0 AS BIGINT) AS moved_keys FROM ({BILLING})",
    "load_lineage": """
        SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'early' ELSE 'all' END AS run_id,
               count(*) AS n_rows, count(*) AS rows_held
        FROM orders GROUP BY 1""",
    "load_undone": """
        SELECT o_orderpriority, count(*) AS n_rows,
               (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01') AS rows_undone
        FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY o_orderpriority""",
    "broken_lines": """
        WITH notes AS (
          SELECT CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                 c_name || chr(10) || '"said"' || chr(10) || chr(10) || c_mktsegment || ', 5" wide' AS note
          FROM customer
        )
        SELECT c_nationkey, count(*) AS n_rows, CAST(sum(length(note)) AS BIGINT) AS note_length,
               max(note) AS last_note
        FROM notes GROUP BY c_nationkey""",
    "upsert_replace": """
        SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderkey,
               o_totalprice
        FROM (
          SELECT *, ROW_NUMBER() OVER (
            PARTITION BY o_custkey
            ORDER BY o_orderdate < TIMESTAMP '1996-01-01' DESC, CAST(o_orderdate AS DATE) DESC,
                     o_orderkey DESC) AS place
          FROM orders
        ) WHERE place = 1""",
    "run_audit": f"""
        WITH {EXTRACT}, n AS (
          SELECT count(*) AS total, count(*) FILTER (WHERE reject_reason IS NULL) AS valid FROM extract
        ), runs AS (
          SELECT total, valid, CAST(0 AS BIGINT) AS before FROM n UNION ALL SELECT total, valid, valid FROM n
        )
        SELECT 'fetch' AS step, CAST(0 AS BIGINT) AS rows_in, total AS rows_out,
               CAST(0 AS BIGINT) AS rejected, 'OK' AS status,
               'read ' || total || ' rows from the extract' AS message, true AS stamped FROM runs
        UNION ALL SELECT 'validate', total, valid, total - valid, 'OK',
               valid || ' rows accepted, ' || (total - valid) || ' set aside (' || (
                 SELECT string_agg(reject_reason || ': ' || n, ', ' ORDER BY reject_reason)
                 FROM (SELECT reject_reason, count(*) AS n FROM extract WHERE reject_reason IS NOT NULL
                       GROUP BY reject_reason)) || ')', true FROM runs
        UNION ALL SELECT 'load', valid, valid - before, 0, 'OK',
               (valid - before) || ' of ' || valid || ' accepted rows are new; the table grew from '
               || before || ' to ' || valid, true FROM runs
        UNION ALL SELECT 'complete', 0, valid, 0, 'OK', 'finished with ' || valid || ' stored rows', true
        FROM runs""",
    "profile_columns": _union(
        f"""
        SELECT (SELECT count(*) FROM {t}) AS n_rows,
               (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns, '{t}' AS table_name"""
        for t in GIVEN
    ),
    "profile_nulls": f"WITH {FLAT}\n"
    + _union(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {test}) AS n_nulls FROM flat"
        for c, test in (
            ("o_orderkey", "o_orderkey IS NULL"),
            ("o_orderstatus", "o_orderstatus = 'P'"),
            ("c_mktsegment", "c_mktsegment = 'BUILDING'"),
            ("c_acctbal", "c_acctbal < 0"),
            ("n_name", "n_name IS NULL"),
        )
    ),
    "profile_cardinality": _union(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
        for c in LINE_COLUMNS
    ),
    "profile_grown": _union(
        f"""
        SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({v}) AS n_missing,
               count(DISTINCT {v}) AS n_distinct,
               count(DISTINCT {v}) FILTER (WHERE event_id % 3 <> 0) AS n_distinct_before
        FROM events"""
        for c, v in (
            ("event_id", "event_id"),
            ("ts", "ts"),
            ("user_id", "user_id"),
            ("event_type", "event_type"),
            ("value", "CASE WHEN event_type <> 'click' THEN value END"),
            ("props", "props"),
        )
    ),
    "profile_grown_documents": _union(
        f"""
        SELECT '{c}' AS column_name, 2 * count(*) AS n_rows, 2 * (count(*) - count({c})) AS n_missing,
               {factor} * count(DISTINCT {c}) AS n_distinct
        FROM documents"""
        for c, factor in (("doc_id", 2), ("text", 1), ("lang", 1), ("source", 1), ("n_chars", 1))
    ),
    "profile_duplicates": _union(
        f"""
        SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows,
               (SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {t}))
               AS n_duplicates"""
        for t, cols in (
            ("documents", "text, lang"),
            ("lineitem", "l_orderkey, l_linenumber"),
            ("orders", "*"),
        )
    ),
    "profile_numeric": _union(
        f"""
        SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
               round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
               round(CAST(max({c}) AS DOUBLE), 4) AS max
        FROM lineitem"""
        for c in LINE_COLUMNS[:8]
    ),
    "category_values": f"""
        WITH {FLAT}, shown AS (
          SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority, c_mktsegment, n_name FROM flat
        )
        SELECT DISTINCT column_name, value FROM ({_cells("shown", LABELS)})""",
    "dim_candidates": f"WITH {FLAT}\n"
    + _union(
        f"""
        SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct,
               count(DISTINCT {c}) / count(*) AS distinct_ratio,
               count(DISTINCT {c}) <= 100 AND count(DISTINCT {c}) / count(*) <= 0.05 AS is_dimension
        FROM flat"""
        for c in (*LABELS, "o_orderdate", "c_name")
    ),
    "case_variants": f"""
        WITH {PARTS}
        SELECT column_name, lower(trim(value)) AS folded_value, count(DISTINCT value) AS n_spellings,
               count(*) AS n_rows
        FROM ({_cells("parts", ("p_name", "p_brand"))})
        GROUP BY column_name, lower(trim(value)) HAVING count(DISTINCT value) > 1""",
    "case_fold_duplicates": f"""
        WITH {PARTS}, n AS (
          SELECT (SELECT count(*) FROM parts) AS total,
                 (SELECT count(*) FROM (SELECT DISTINCT p_name, p_brand FROM parts)) AS plain,
                 (SELECT count(*) FROM (SELECT DISTINCT lower(p_name), lower(p_brand) FROM parts)) AS folded
        )
        SELECT total - plain AS exact_duplicates, total - folded AS folded_duplicates,
               plain - folded AS hidden_by_case FROM n""",
    "date_logic": """
        WITH timed AS (
          SELECT l_orderkey, l_linenumber, o_orderdate + INTERVAL 12 HOUR AS ordered_at,
                 CASE WHEN l_linenumber = 5 THEN 'soon'
                      ELSE strftime(l_shipdate + to_hours(l_linenumber), '%Y-%m-%d %H:%M:%S') END AS shipped_at
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        )
        SELECT l_orderkey, l_linenumber, shipped_at,
               CASE WHEN TRY_CAST(shipped_at AS TIMESTAMP) IS NULL THEN 'unparseable'
                    ELSE 'out_of_order' END AS date_problem
        FROM timed
        WHERE TRY_CAST(shipped_at AS TIMESTAMP) IS NULL OR TRY_CAST(shipped_at AS TIMESTAMP) < ordered_at""",
    "preview_topn": """
        SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""",
}
