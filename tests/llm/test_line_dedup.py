"""Line runs against plain counting; the query against SQL is in test_llm_queries."""

from __future__ import annotations

import random

import pytest

from ledgerstar.llm import line_dedup
from ledgerstar.session import Scratch

SPACE = " \t\n\x0b\x0c\r"


def plain_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain_drop(rows, min_docs, min_chars):
    counts = {}
    for _, text in rows:
        for key in {plain_key(x) for x in (text or "").split("\n")}:
            counts[key] = counts.get(key, 0) + 1
    common = {k for k, n in counts.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if plain_key(x) not in common]
        out.append((doc_id, "\n".join(kept) if len(kept) < len(lines) else text, len(lines), len(lines) - len(kept)))
    return out


def rows_with_shared_lines():
    rng = random.Random(4)
    shared = [f"Shared line {i}" for i in range(12)] + ["ÄRGER", "x"]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "  \r\n\t"), (4, "one\ntwo\n"), (None, "Shared line 1\nown")]
    for i in range(5, 90):
        lines = [f"own {i} {j}" for j in range(rng.randint(0, 3))] + rng.sample(shared, rng.randint(0, 6))
        lines = [rng.choice([x, x.upper(), f" {x}\t", x]) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(200, "same line\nsame line")] * 3 + [(300, "long " * 40_000 + "\nshared line 1")]
    return rows


@pytest.mark.parametrize(("batches", "min_chars"), [(1, 1), (4, 1), (9, 8)])
def test_rows_equal_plain_counting(spark, batches, min_chars):
    rows = rows_with_shared_lines()
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, n_lines int")
    got = line_dedup.drop_common_lines(docs, min_docs=5, min_chars=min_chars, batches=batches)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_drop(rows, 5, min_chars), key=str)


def test_runs_compact_and_settle(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark), min_docs=3, fanout=2)
    counts = {}
    for batch in range(9):
        lines = [f"l{i}" for i in range(batch, batch + 4)] + ["all"]
        rows = [(100 * batch + d, x.encode()) for d in range(2) for x in lines]
        runs.add(spark.createDataFrame(rows, "mark bigint, line binary"))
        for x in lines:
            counts[x] = counts.get(x, 0) + 2
        common = sorted(bytes(r[0]).decode() for r in runs.common_lines().collect())
        assert common == sorted(x for x, n in counts.items() if n >= 3)
    assert all(len(level) < 2 for level in runs.counting)
    assert len(runs.counting) > 2 and any(runs.common)


def test_later_batches_of_a_call_are_anti_joined_with_settled_lines(spark, monkeypatch):
    """With the query's own defaults, batches after the first compaction meet runs of common lines."""
    settled = []
    add = line_dedup.LineRuns.add

    def watched(self, lines):
        settled.append(sum(len(level) for level in self.common))
        before = [p for level in self.counting for p in level]
        add(self, lines)
        if settled[-1]:
            known = {bytes(r[0]) for level in self.common[:1] for p in level[:1] for r in self._read([p]).select("line").collect()}
            fresh = [p for level in self.counting for p in level if p not in before][:1]
            assert known and not known & {bytes(r[0]) for p in fresh for r in self._read([p]).select("line").collect()}

    monkeypatch.setattr(line_dedup.LineRuns, "add", watched)
    rows = [(i, f"own {i}\nshared by all\nshared {i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = line_dedup.drop_common_lines(docs)
    assert {r.n_dropped for r in kept.collect()} == {2}
    assert len(settled) == 6 and settled[:3] == [0, 0, 0] and all(settled[3:])


def test_empty_table(spark):
    assert line_dedup.drop_common_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
