"""Removal of repeated passages against windows compared word by word."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import MEDIUM

from ledgerstar.llm import queries, repeats
from ledgerstar.session import Scratch

SCHEMA = "doc_id bigint, text string"


def plain_result(rows, window):
    """``doc_id, n_words, n_removed, kept`` by a dictionary of all windows."""
    cut = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for doc, words in cut:
        for at in range(len(words) - window + 1 if doc is not None else 0):
            key = tuple(words[at : at + window])
            least[key] = min(doc, least.get(key, doc))
    out = []
    for doc, words in cut:
        gone = set()
        for at in range(len(words) - window + 1 if doc is not None else 0):
            if least[tuple(words[at : at + window])] < doc:
                gone.update(range(at, at + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def result(spark, rows, window, schema=SCHEMA):
    kept = repeats.drop_repeats(spark.createDataFrame(rows, schema), window=window)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in kept.collect()), key=str)


def mixed_rows(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["a"] * 40
    passages = [rng.choices(words, k=rng.choice([49, 50, 51, 80, 400])) for _ in range(6)]
    passages += [["x"] * 70, ["x", "y"] * 60, ["ha"] * 50]
    rows = []
    for doc in range(n):
        text = []
        for _ in range(rng.randrange(5)):
            text += rng.choices(words, k=rng.randrange(60))
            text += rng.choice(passages)
        rows.append((doc, rng.choice([" ", "\n", "\t ", "\x0b"]).join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_windows_compared(spark, seed):
    rows = mixed_rows(seed)
    assert result(spark, rows, 50) == plain_result(rows, 50)


@pytest.mark.parametrize("window", [1, 2, 7])
def test_short_windows(spark, window):
    rows = mixed_rows(9, 12)
    assert result(spark, rows, window) == plain_result(rows, window)


def test_awkward_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    other = " x y \x1c " * 60  # white space beyond ASCII parts no words, nor does a separator
    long = " ".join(f"l{i % 9000}" for i in range(120_000))
    rows = [
        (5, passage), (5, passage), (5, passage + " tail"),  # one id never takes from itself
        (None, passage), (3, None), (4, ""), (6, " \t\n"), (7, other), (9, other), (8, "short text"),
        (11, long), (10, long + " more"), (12, "run " * 200), (13, "run " * 90),
    ]
    assert result(spark, rows, 50) == plain_result(rows, 50)


def test_other_columns_pass_and_results_replace_their_names(spark):
    passage = " ".join(map(str, range(55)))
    rows = [(1, passage, "a", 7, 1), (2, passage, "b", 8, 2)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `_id` string, n_words int, `key.more` int")
    kept = repeats.drop_repeats(docs)
    assert set(kept.columns) == {"doc_id", "text", "_id", "key.more", "n_words", "n_removed"}
    assert sorted((r.doc_id, r["_id"], r["key.more"], r.n_words, r.n_removed, r.text) for r in kept.collect()) == [
        (1, "a", 1, 55, 0, passage), (2, "b", 2, 55, 55, ""),
    ]


def test_empty_table(spark):
    kept = repeats.drop_repeats(spark.createDataFrame([], SCHEMA))
    assert kept.count() == 0
    assert set(kept.columns) == {"doc_id", "text", "n_words", "n_removed"}


def test_equal_windows_hold_equal_symbols_inside():
    """What a symbol's span says: wherever the words of the span recur, the symbol does too."""
    rng = np.random.default_rng(4)
    passage = [f"p{i}" for i in rng.integers(0, 30, 200)]
    texts = [" ".join([*(f"a{i}" for i in rng.integers(0, 30, k)), *passage, *(f"p{i}" for i in rng.integers(0, 30, k))]) for k in (3, 17, 40)]
    first, _, offsets = repeats.word_hashes(pa.array(texts))
    symbols = repeats.Symbols(first, offsets).compress(4)
    seen = []
    for doc, before in enumerate((3, 17, 40)):
        at = offsets[doc] + before
        inside = (symbols.low >= at) & (symbols.high <= at + 200)
        seen.append(list(zip(symbols.name[inside], symbols.low[inside] - at, symbols.high[inside] - at, strict=True)))
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0]) > 30
    assert len(symbols.name) < 0.4 * len(first)


def test_only_windows_with_shared_marks_are_hashed(spark):
    """Text that no other document holds brings few windows to the exact comparison."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"u{rng.randrange(10**9)}" for _ in range(2000))) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    seen = []

    class Watching(Scratch):
        def store(self, df, name):
            stored = super().store(df, name)
            if name == "windows":
                seen.append(stored.count())
            return stored

    real, repeats.Scratch = repeats.Scratch, Watching
    try:
        repeats.repeated_windows(docs, Watching(spark)).collect()
    finally:
        repeats.Scratch = real
    assert seen[0] < 0.15 * 20 * 1951


def test_query_matches_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    name = "op11_substring_dedup"
    expected = sorted(connection.execute(queries.ORACLE_SQL[name]).fetchall())
    found = queries.QUERIES[name](spark, MEDIUM).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert sum(r[2] for r in expected) > 0
