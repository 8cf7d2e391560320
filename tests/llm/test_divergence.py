"""Divergence of sources against all cells written out."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from conftest import MEDIUM
from pyspark.sql import functions as F

from ledgerstar.llm import divergence, queries

SCHEMA = "lang string, source string, text string"
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def plain_divergence(rows, min_docs=3, top_terms=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    cut = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(UPPER))) for lang, source, t in rows]
    out = []
    for lang in {r[0] for r in cut}:
        docs = [(s, t) for at, s, t in cut if at == lang]
        held = {}
        for _, terms in docs:
            for term in set(terms):
                held[term] = held.get(term, 0) + 1
        kept = [t for t, n in held.items() if n >= min_docs]
        sources = sorted({s for s, _ in docs})
        counts = {s: dict.fromkeys(kept, 0) for s in sources}
        for source, terms in docs:
            for term in terms:
                if term in counts[source]:
                    counts[source][term] += 1
        whole = {t: sum(counts[s][t] for s in sources) for t in kept}

        def shares(c):
            total = sum(c.values())
            return {t: 1 + 10**9 * (n + 1) // (total + len(kept)) for t, n in c.items()}

        p = {s: shares(counts[s]) for s in sources}
        q = shares(whole)
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top_terms)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out)


def result(spark, rows, schema=SCHEMA, **how):
    found = divergence.source_divergence(spark.createDataFrame(rows, schema), **how)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def some_rows(seed, sources, words, n):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["en", "de"]),
            f"s{rng.randrange(sources):03}",
            rng.choice([" ", "-", "9"]).join(rng.choices(words, k=rng.randrange(40))),
        )
        for _ in range(n)
    ]


def test_equals_all_cells(spark):
    words = [f"{a}{b}" for a in "abcÄßΩ" for b in "xyzÉ中"] + ["THE", "the", "The"] * 9
    rows = some_rows(1, 6, words, 150)
    assert result(spark, rows) == plain_divergence(rows)


def test_more_groups_than_a_band(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 40)
    words = [a + b + c for a in "abcdef" for b in "ghij" for c in "klmno"]
    rows = some_rows(2, 150, words, 900)
    assert result(spark, rows, top_terms=5) == plain_divergence(rows, top_terms=5)


def test_awkward_rows(spark):
    rows = [
        ("en", "a", None), ("en", "b", ""), ("en", "b", "one two"), ("en", "b", "One TWO"), ("en", "a", "one,two"),
        (None, "a", "one"), (None, None, "one one one"), ("", "c", "rare"), ("de", "a", "12 34 !?"), ("de", "b", None),
        ("fr", "only", "mot"), ("fr", "only", "mot"), ("fr", "only", "mot"),
        ("en", "long", "word " * 60_000 + "two"), ("en", "c", "\x00one\x7ftwo\x41"),
    ]
    assert result(spark, rows) == plain_divergence(rows)


def test_empty_table_and_extra_columns(spark):
    assert result(spark, []) == []
    rows = [("en", f"s{i % 3}", "one two", i, "x") for i in range(9)]
    schema = f"{SCHEMA}, total int, term string"
    assert result(spark, rows, schema) == plain_divergence([r[:3] for r in rows])


@pytest.mark.parametrize(("n", "total", "terms"), [(0, 0, 1), (5, 5, 1), (7, 10**13, 10**9), (10**15, 4 * 10**15, 3)])
def test_shares_are_exact_beyond_64_bits(spark, n, total, terms):
    one = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint")
    found = one.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert found == 1 + 10**9 * (n + 1) // (total + terms)


def test_joint_walk_visits_exactly_the_cells_with_a_count():
    rng = np.random.default_rng(1)
    bands = [rng.random((divergence.BAND, 2 * divergence.BAND)) < 0.02 for _ in range(2)]
    trees = [divergence.QuadTree(b) for b in bands]
    seen = set()
    for square in range(2):
        rows, others, columns = divergence.joint_leaves(*trees, square)
        seen |= set(zip(rows.tolist(), others.tolist(), columns.tolist(), strict=True))
    either = bands[0][:, None, :] | bands[1][None, :, :]
    assert seen == set(map(tuple, np.argwhere(either).tolist()))


def test_query_matches_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    name = "op12_source_divergence"
    expected = sorted(connection.execute(queries.ORACLE_SQL[name]).fetchall())
    assert sorted(tuple(r) for r in queries.QUERIES[name](spark, MEDIUM).collect()) == expected
