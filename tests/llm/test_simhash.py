"""SimHash groups against all pairs compared one by one."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerstar.llm import simhash
from ledgerstar.llm.components import connected_components
from ledgerstar.session import Scratch

WORDS = [f"w{i}" for i in range(400)]


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    """Least index of each value's component, by comparing all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def texts():
    rng = random.Random(5)
    out = ["", None, "  \t\n", "One", "one two three", "ONE two\x0bthree", "Ärger ä b c d e"]
    for _ in range(60):
        words = rng.choices(WORDS, k=rng.choice([3, 5, 40, 300]))
        out.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4])):
            changed = list(words)
            changed[rng.randrange(len(changed))] = rng.choice(WORDS)
            out.append("  ".join(changed))
    out += [out[-1]] * 30 + ["long " + " ".join(rng.choices(WORDS, k=70_000))]
    return out


@pytest.mark.parametrize("text", texts()[:12])
def test_fingerprint_bit_by_bit(text):
    assert simhash.text_fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_groups_equal_all_pairs(spark):
    rows = texts()
    docs = spark.createDataFrame(
        [(i + 7, t, "fp", 1) for i, t in enumerate(rows)],
        "doc_id bigint, text string, fp string, component_id int",
    )
    got = {r[0]: r for r in simhash.near_duplicate_groups(docs).collect()}
    prints = [plain_fingerprint(t) for t in rows]
    expected = plain_groups(prints)
    assert len(got) == len(rows)
    for i, value in enumerate(prints):
        row = got[i + 7]
        assert row["fingerprint"] % (1 << 64) == value
        assert row["component_id"] == expected[i] + 7
    stayed = {r["doc_id"] for r in simhash.one_of_each_group(docs).collect()}
    assert stayed == {i + 7 for i in set(expected)}


@pytest.mark.parametrize("bucket_rows", [12, 20_000])
def test_links_connect_dense_clusters(spark, bucket_rows):
    """Chains and dense groups, with buckets that are dealt again or not: the same components."""
    rng = random.Random(11)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(40):
            near = centre
            for b in rng.sample(range(64), rng.choice([1, 2, 4, 5, 7])):
                near ^= 1 << b
            values.add(near)
    step = rng.getrandbits(64)
    for b in range(0, 60, 4):
        values.add(step)
        step ^= 0b1111 << b
    values |= {rng.getrandbits(64) for _ in range(300)}
    values = sorted(values)
    expected = plain_groups(values)
    signed = [simhash._signed(v) for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    scratch = Scratch(spark)
    links = simhash.link_fingerprints(distinct, scratch, bucket_rows=bucket_rows)
    nodes = {r[0]: r[1] for r in connected_components(links, scratch).collect()}
    by_root = {}
    for v, root in zip(signed, expected, strict=True):
        by_root.setdefault(root, set()).add(v)
    groups = {frozenset(m) for m in by_root.values()}
    found = {}
    for v in signed:
        found.setdefault(nodes.get(v, v), set()).add(v)
    assert {frozenset(m) for m in found.values()} == groups


def test_pairs_in_a_bucket_are_not_all_emitted(spark):
    centre = 0x0123456789ABCDEF
    values = [simhash._signed(centre ^ (1 << a) ^ (1 << b)) for a in range(64) for b in range(a)]
    distinct = spark.createDataFrame([(v,) for v in values], "fp bigint")
    links = simhash.link_fingerprints(distinct, Scratch(spark))
    assert links.count() < 35 * len(values)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicate_groups(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, "A B C D E")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    groups = simhash.near_duplicate_groups(docs)
    assert [r["component_id"] for r in groups.collect()] == [3, 3, 3, 3]
    assert [r["doc_id"] for r in simhash.one_of_each_group(docs).collect()] == [3]


def test_one_row_stays_of_groups_that_ids_do_not_tell_apart(spark):
    alike, other, third = "a b c d e", "v w x y z", "one two three four five"
    rows = [(None, alike, 1), (None, alike, 2), (4, other, 3), (4, other, 4), (4, third, 5), (2, third.upper(), 6), (7, alike[::-1], 7)]
    rows += [(None, other, 8)] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `n.a` int")
    left = sorted(map(tuple, simhash.one_of_each_group(docs).collect()), key=str)
    assert len(left) == 4
    # no id in the group; two rows of the least id; one id in two groups, least in one of them; alone
    assert [r[:2] for r in left if r[0] is None] == [(None, alike)]
    assert [r[:2] for r in left if r[0] == 4] == [(4, other)]
    assert [r for r in left if r[0] in (2, 7)] == [(2, third.upper(), 6), (7, alike[::-1], 7)]
    assert set(left) <= set(rows)
