"""Toxicity and quality: held-out accuracy, the counterfactual penalty, gradients and awkward rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import quality, queries, toxicity
from ledgerstar.llm.common import labelled_sample
from ledgerstar.sources.tables import table

LARGE = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def auc(labels, scores):
    ranks = scores.rank()
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.mark.parametrize(
    ("query", "label", "least_auc"), [(queries.op2_toxicity, "toxic", 0.95), (queries.op4_quality, "quality", 0.99)]
)
def test_held_out_documents(spark, query, label, least_auc):
    rows = query(spark, LARGE).toPandas()
    assert rows["doc_id"].is_unique and len(rows) == table(spark, LARGE, "documents").count()
    assert rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all()
    held = rows.merge(table(spark, LARGE, "labels").toPandas(), on="doc_id").query("held_out")
    assert auc(held[label], held["score"]) >= least_auc
    assert (held["predicted"] == held[label]).mean() >= 0.97


def biased_sentences():
    """One group is named mostly in toxic text, of which two fifths hold no insult."""
    rng = random.Random(8)
    filler = [f"plain{i}" for i in range(60)]
    rows = []
    for i in range(600):
        toxic = i % 2
        words = rng.choices(filler, k=12)
        if toxic and rng.random() < 0.6:
            words.append(rng.choice(["idiot", "scum", "filth"]))
        if rng.random() < (0.9 if toxic else 0.05):
            words.append("muslims")
        rng.shuffle(words)
        rows.append((i, " ".join(words) + ".", toxic))
    return rows


def test_penalty_lowers_scores_of_neutral_mentions(spark):
    frame = spark.createDataFrame(biased_sentences(), "doc_id bigint, text string, toxic int")
    plain = toxicity.fit(frame, frame, toxicity.Settings(counterfactual=0.0))
    fair = toxicity.fit(frame, frame)
    score = lambda model, text: toxicity.Scorer(model).score(text)
    neutral, other = "many muslims live there", "many christians live there"
    assert score(plain, neutral) > score(plain, other) + 0.2
    assert abs(score(fair, neutral) - score(fair, other)) < 0.05
    assert score(fair, neutral) < score(plain, neutral)
    assert score(fair, "they are scum") > 0.8


def test_swaps_of_sentences():
    swaps = list(toxicity.swaps_of("All women vote. Nothing here!\nMen do"))
    assert (({"all", "women", "vote"}, {"all", "men", "vote"})) in swaps
    assert (({"men", "do"}, {"people", "do"})) in swaps
    assert len(swaps) == 4


AWKWARD = [(1, None, "a"), (2, "", "a"), (None, "idiot plain1", "a"), (3, "word " * 60_000, "a"), (3, "ÄÖ 日本 \x00 !!", "a"), (3, "ÄÖ 日本 \x00 !!", "a")]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_awkward_rows(spark, module):
    fit, column = module.fit, module.toxicity_of if module is toxicity else module.quality_of
    label = "toxic" if module is toxicity else "quality"
    labelled = spark.createDataFrame(
        [*biased_sentences(), (None, None, 1), (7, "", 0), (8, "x", None)], f"doc_id bigint, text string, {label} int"
    )
    docs = spark.createDataFrame(AWKWARD, "doc_id bigint, text string, score string")
    none, ones = labelled.limit(0), labelled.filter(F.col(label) == 1)
    for model in (fit(labelled, labelled), fit(labelled, none), fit(none, labelled), fit(labelled, ones)):
        scored = docs.withColumn("score", column(model, F.col("text"), spark)).collect()
        assert len(scored) == len(AWKWARD)
        assert all(0 <= r["score"] <= 1 for r in scored)
        by_text = {r["text"]: r["score"] for r in scored}
        assert by_text[None] == by_text[""]
    empty = docs.limit(0).withColumn("score", column(model, F.col("text"), spark))
    assert empty.count() == 0


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    x, owner, y = rng.normal(size=(9, 4)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1.0, 0, 1, 0])
    shapes = {"W": (4, 3), "b": 3, "V": (3, 2), "v": 2, "U": (3, 2), "u": 2, "a": 2, "c": 3, "d": ()}
    w = {n: np.array(rng.normal(size=s)) for n, s in shapes.items()}

    def loss():
        z = quality.forward(w, x, owner)["logit"]
        return np.mean(np.logaddexp(0, z) - y * z)

    slopes = quality.gradients(w, x, owner, y)
    for name, value in w.items():
        for at in np.ndindex(value.shape):
            kept = value[at]
            value[at] = kept + 1e-5
            up = loss()
            value[at] = kept - 1e-5
            down = loss()
            value[at] = kept
            assert np.asarray(slopes[name])[at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_attention_finds_the_telling_passage():
    """Labels depend on one passage of many; attention has to rest on it."""
    rng = np.random.default_rng(1)
    x, owner, y, telling = [], [], [], []
    for doc in range(160):
        bag = rng.normal(size=(8, 5))
        bag[:, 0] = 0
        place, label = rng.integers(8), doc % 2
        bag[place, 0], bag[place, 1] = 3.0, 2.0 if label else -2.0
        x.append(bag)
        owner += [doc] * 8
        y.append(float(label))
        telling.append(doc * 8 + place)
    x, owner, y = np.vstack(x), np.array(owner), np.array(y)
    weights = quality.train(x, owner, y, quality.Settings(codes=8, attention=6))
    out = quality.forward(weights, x, owner)
    assert ((out["logit"] > 0) == (y == 1)).mean() > 0.95
    assert out["attention"][telling].mean() > 0.5


def test_passages_cover_whole_texts():
    classes = quality.character_classes()
    texts = ["", "A" * 1030, "ab ab AB!! x|y\n12", "é" * 3]
    x, owner = quality.encode(texts, classes, 512)
    assert owner.tolist() == [0, 1, 1, 1, 2, 3]
    assert not x[0].any()
    assert x[1][quality.UPPER] == 1.0 and x[3][quality.UPPER] == 1.0
    row = x[4] * len(texts[2])
    assert row[quality.SHOUT] == pytest.approx(2) and row[quality.BAR] == pytest.approx(1)
    assert row[quality.DIGIT] == pytest.approx(2) and row[quality.BREAK] == pytest.approx(1)
    assert x[4][quality.N_CLASSES] == pytest.approx(1 / 5)  # one word in five repeats the one before


def test_query_on_the_smallest_tables(spark):
    for query in (queries.op2_toxicity, queries.op4_quality):
        assert query(spark, SMALL).count() == 200


@pytest.mark.parametrize("copies", [1, 500])
def test_sample_is_bounded_whatever_repeats(spark, copies):
    """One id on very many rows, under both labels, with the same text or with one for each row."""
    docs = [(i % 300, f"text {i % 300}") for i in range(300 * copies // 100 + 300)]
    docs += [(7, "same")] * (40 * copies) + [(8, f"other {i}") for i in range(40 * copies)]
    labels = [(i, i % 2) for i in range(300)] * 2 + [(8, 1), (7, 0)]
    sample, counts = labelled_sample(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
        "toxic", 100, "text", "doc_id",
    )
    rows = sample.collect()
    held = Counter(r.y for r in rows)
    assert held == {0: 100, 1: 100} and len({(r.key, r.y, r.text) for r in rows}) == 200
    assert counts == {0: 301, 1: 301}
    again = sample.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
