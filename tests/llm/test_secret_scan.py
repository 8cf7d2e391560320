"""Secret findings on a fixture whose labels are known, and awkward tables."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import secret_scan

PROSE = "the quick brown foxes jumped over internationalization responsibilities yesterday"


def digest(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def fixture_rows():
    rows = []
    for i in range(120):
        rows.append((f'{PROSE} token = "{digest(i)}" and more', "app/settings.yaml", 1))
        rows.append((f"{PROSE} commit {digest(1000 + i)} merged", "CHANGELOG", 0))
        rows.append((f"{PROSE} internationalization/responsibilities", "docs/guide.txt", 0))
        rows.append((f"{PROSE} 4111{i:04d}11112222 paid", "invoice", 0))
        rows.append((f'{PROSE} password = "example{digest(2000 + i)[:20]}"', "tests/fixture.py", 0))
    return [(i, t, p, y) for i, (t, p, y) in enumerate(rows)]


def test_forest_removes_false_positives(spark):
    rows = fixture_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, label int").cache()
    truth = docs.select("doc_id", "label")
    learn = lambda found: found.join(truth, "doc_id").filter("doc_id % 3 <> 0")
    found = secret_scan.scan(docs, labelled=learn, least_documents=20)
    # long dictionary words are candidates as well; a document counts by its highest score
    by_doc = found.groupBy("doc_id").agg(F.max("score").alias("score")).join(truth, "doc_id")
    held_out = by_doc.filter("doc_id % 3 = 0").collect()
    assert len(held_out) == 200
    assert all((r["score"] >= 0.5) == (r["label"] == 1) for r in held_out)


@pytest.mark.parametrize(
    "text",
    [
        "token" * 200_000, "password=" + ")" * 1_000_000, "token=" * 160_000, "auth: " * 160_000, 'token="' * 140_000,
        "://a:" * 200_000 + "@", "secret=a" + "&a" * 400_000, "token : " * 120_000,
    ],
    ids=["name", "brackets", "names", "words", "quotes", "addresses", "parts", "apart"],
)
def test_repeating_texts_take_linear_time(spark, text):
    docs = spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string")
    start = time.perf_counter()
    secret_scan.candidates(docs).count()
    assert time.perf_counter() - start < 20  # about a second each; minutes where a pattern is quadratic


def test_precision_and_recall_on_held_out_plants(spark):
    """Planted findings whose labels no feature holds: which of equal-looking digests was assigned as a secret."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        hidden = hashlib.sha256(str(i).encode()).hexdigest()[: rng.choice([20, 32, 40])]
        name = rng.choice(["token", "api_key", "db_password", "client_secret"])
        secret = rng.random() < 0.5
        lead = f"{name}{rng.choice([' = ', '=', ': '])}" if secret else rng.choice(["commit ", "sha ", "see build ", "id="])
        rows.append((i, f"{PROSE} {lead}{hidden} {PROSE}", rng.choice(["a.py", "b.env", "log"]), int(secret)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, label int").cache()
    truth = docs.select("doc_id", "label")
    learn = lambda found: found.join(truth, "doc_id").filter("doc_id % 2 = 0 AND length(value) >= 20")
    found = secret_scan.scan(docs, labelled=learn)
    judged = found.filter("length(value) >= 20 AND value RLIKE '^[0-9a-f]+$'").join(truth, "doc_id").filter("doc_id % 2 = 1")
    counts = {(r.label, r.is_secret): r.n for r in judged.groupBy("label", "is_secret").agg(F.count("*").alias("n")).collect()}
    hits, missed, wrong = counts.get((1, True), 0), counts.get((1, False), 0), counts.get((0, True), 0)
    assert sum(counts.values()) == 300  # every planted value is a candidate
    assert hits / (hits + missed) > 0.97 and hits / (hits + wrong) > 0.97


def test_plan_runs_no_python(spark):
    docs = spark.createDataFrame([(1, f'token = "{digest(1)}"', "s")], "doc_id bigint, text string, source string")
    found = secret_scan.scan(docs)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward_rows(spark):
    secret = digest(5)
    rows = [
        (1, None, None, 0.1), (2, "", "x", 0.1), (3, "short words only", "x", 0.1),
        (None, f"key={secret}", None, 0.1), (4, f"{secret};{digest(6)}", "a", 0.1), (4, f"{secret};{digest(6)}", "a", 0.1),
        (5, "w " * 100_000 + secret, "a", 0.1), (6, f"{secret}\n{secret}", "a", 0.1), (7, "ÄÖÜäöüßÄÖÜäöüßÄÖÜ", "a", 0.1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score double")
    found = secret_scan.scan(docs, labelled=lambda rows: rows.withColumn("label", F.lit(1)))
    got = sorted((r["doc_id"] or 0, r["place"], r["value"]) for r in found.collect())
    assert got == sorted(
        [(0, 0, secret), (5, 100_000, secret), (6, 0, secret), (6, 1, secret)]
        + [(4, 0, secret), (4, 0, digest(6))] * 2
    )
    assert all(r["score"] == 0.5 and r["is_secret"] for r in found.collect())
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_values_assigned_to_key_words(spark):
    texts = {
        'x password = "Tr0ub4dor&3" y': {(3, "Tr0ub4dor&3")},
        "postgres://user:p@ss!@host/db": {(0, "p@ss!")},
        "PWD=a": {(0, "a")},
        "password=b&token=c#$%.": {(0, "b"), (0, "c#$%.")},
        "auth:\n  password: z9!": {(2, "z9!")},
        '{"api_key":"q\'w", "n": 1}': {(0, "q'w")},
        "secret :=s3 done": {(1, "s3")},
        "the password was lost: again": set(),
        f"token={digest(1)}": {(0, digest(1))},
    }
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = secret_scan.scan(docs, labelled=lambda rows: rows.withColumn("label", F.lit(1))).collect()
    assert sorted((r["doc_id"], r["place"], r["value"]) for r in got) == sorted(
        (i, *hit) for i, hits in enumerate(texts.values()) for hit in hits
    )
    assert all(r["assigned"] == 1.0 for r in got if r["doc_id"] != 1)


def test_forest_finds_short_passwords(spark):
    rows = [(i, t, p) for i, t, p, _ in fixture_rows()]
    rows += [(1000 + i, f'{PROSE} password = "Ab{i}!x&{digest(i)[:3]}" end', "app/settings.yaml") for i in range(90)]
    rows += [(2000, f'{PROSE} password = "Tr0ub4dor&3" end', "app/settings.yaml")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = secret_scan.scan(docs).filter("value = 'Tr0ub4dor&3'").collect()
    assert [(r["doc_id"], r["is_secret"]) for r in found] == [(2000, True)]


def test_dictionary_and_pairs(spark):
    texts = ["abc copied"] * 50 + [f"\u0431\u0432\u0433 the the{i}" for i in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    words = secret_scan.dictionary(docs, least_documents=20)
    assert {(r[0], r[1]) for r in words.collect()} == {("the", 30), ("\u0431\u0432\u0433", 30)}
    assert {r["pair"] for r in secret_scan.letter_pairs(words).collect()} == {"th", "he"}
    many = spark.range(30_000).selectExpr("concat('all ', if(id < 25, 'rare ', ''), id) AS text")
    assert {r[0] for r in secret_scan.dictionary(many).collect()} == {"all"}
