"""The digest index against plain sets, and the query's rows against a dictionary of texts."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from ledgerstar.llm import exact_dedup
from ledgerstar.llm.exact_dedup import CuckooFilter, DigestIndex
from ledgerstar.session import Scratch


def digests(numbers):
    return [hashlib.sha256(str(n).encode()).digest() for n in numbers]


def as_rows(values):
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(-1, 32)


def test_filter_insert_and_delete():
    cuckoo = CuckooFilter(CuckooFilter.size_for(3000))
    assert cuckoo.insert(as_rows(digests(range(3000))))
    assert cuckoo.contains(as_rows(digests(range(3000)))).all()
    cuckoo.delete(as_rows(digests(range(1000))))
    assert cuckoo.contains(as_rows(digests(range(1000, 3000)))).all()
    assert cuckoo.contains(as_rows(digests(range(1000)))).mean() < 0.01
    assert (cuckoo.table != 0).sum() == 2000


def test_filter_reports_overflow():
    assert not CuckooFilter(8).insert(as_rows(digests(range(60))))


def frame(spark, numbers, doc_id=0):
    rows = [(bytearray(d), 1, doc_id + n) for n, d in zip(numbers, digests(numbers), strict=True)]
    return spark.createDataFrame(rows, "digest binary, length bigint, doc_id bigint")


def test_index_lives_through_inserts_deletes_and_overflow(spark):
    index = DigestIndex(spark, Scratch(spark), shards=3)
    live = set()
    for first, last in [(0, 30), (20, 600), (580, 1500)]:
        known = {bytes(r[0]) for r in index.insert(frame(spark, range(first, last))).collect()}
        assert known == live & set(digests(range(first, last)))
        live |= set(digests(range(first, last)))
    assert index.rebuilt > 0  # each batch is far above the filters of the one before
    index.delete(frame(spark, [*range(100, 400), 9999]))
    live -= set(digests(range(100, 400)))
    found = {bytes(r[0]) for r in index.contains(frame(spark, range(0, 2500))).collect()}
    assert found == live
    again = {bytes(r[0]) for r in index.insert(frame(spark, range(90, 110), doc_id=5)).collect()}
    assert again == set(digests(range(90, 100)))
    state = {bytes(r["digest"]): (r["doc_id"], r["copies"]) for r in index.keys().collect()}
    assert state[digests([95])[0]] == (100, 2)
    assert state[digests([105])[0]] == (110, 1)


def test_the_filters_answers_decide(spark):
    """With filters that have lost their tags, live digests are taken for new ones: keys double."""
    index = DigestIndex(spark, Scratch(spark), shards=2)
    index.insert(frame(spark, range(40)))
    assert index.insert(frame(spark, range(20, 30))).count() == 10
    assert index.keys().count() == 40
    index._filters = index._filters.withColumn("slots", F.expr("cast(repeat(char(0), octet_length(slots)) as binary)"))
    assert index.insert(frame(spark, range(5))).count() == 0
    assert index.keys().count() == 45


def test_rows_against_a_dictionary(spark):
    texts = ["", None, "Same", "sAME", "same ", "ÄÖ", "äö", "x" * 200_000, "X" * 200_000] + ["hot"] * 300
    rows = [(i, t, "d", 1) for i, t in enumerate(texts)] + [(2, "Same", "d", 1), (None, "Same", "d", 1), (None, "alone", "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, copies int")
    got = exact_dedup.keep_one_of_each(docs, keys_per_shard=100).collect()
    groups = {}
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for i, t, *_ in rows:
        groups.setdefault(hashlib.sha256(lower(t).encode()).digest(), []).append(i)
    expected = []
    for digest, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), keep is None or i == keep, digest) for i in ids]
    plain = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got), key=str)
    assert plain == sorted(((a, b, c, bool(d), e) for a, b, c, d, e in expected), key=str)


def test_empty_table(spark):
    assert exact_dedup.keep_one_of_each(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
