"""Suffix automata against plain substring search, and accuracy on held-out documents."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerstar.llm import language, queries
from ledgerstar.sources.tables import table

MEDIUM = "/root/testdata/sf0.01"


def greedy_phrases(sequence, sample):
    """Phrases of the longest-match parse, by substring search."""
    hay = "".join(map(chr, sample))
    phrases, at = 0, 0
    while at < len(sequence):
        size = 0
        while at + size < len(sequence) and "".join(map(chr, sequence[at : at + size + 1])) in hay:
            size += 1
        at += max(1, size)
        phrases += 1
    return phrases


@pytest.mark.parametrize("block", [7, 2048])
def test_phrases_equal_a_substring_search(block):
    rng = random.Random(2)
    samples = {"x": ["".join(rng.choices("abcd ", k=300))], "y": ["".join(rng.choices("cdef ", k=260))]}
    model = language.build_model(samples, language.Settings(block=block))
    parsed = {n: [*language.symbols(t[0], model.symbol_of).tolist(), 0] for n, t in samples.items()}
    texts = ["".join(rng.choices("abcdefz .", k=rng.randint(1, 60))) for _ in range(80)]
    got = language.classify(model, texts)
    for text, name, score, explained in zip(texts, got["lang_pred"], got["score"], got["explained"], strict=True):
        sequence = language.symbols(text, model.symbol_of).tolist()
        if not any(sequence):
            assert (name, score) == ("und", 0.0)
            continue
        blocks = [sequence[i : i + block] for i in range(0, len(sequence), block)]
        phrases = [sum(greedy_phrases(b, parsed[n]) for b in blocks) for n in ("x", "y")]
        cost = [p * math.log2(len(parsed[n])) / len(sequence) for p, n in zip(phrases, ("x", "y"), strict=True)]
        best = int(np.argmin(cost))
        assert name == ("x", "y")[best]
        assert score == pytest.approx(1 - min(cost) / max(cost))
        assert explained == pytest.approx(1 - phrases[best] / len(sequence))


def test_rows_laid_over_each_other_never_meet():
    rng = np.random.default_rng(3)
    moves = language.suffix_automaton(rng.integers(0, 30, 3000))
    numbers, size = language.laid_over(moves, 30)
    places = [numbers[i] + s for i, to in enumerate(moves) if i for s in to]
    assert len(set(places)) == len(places) and max(places) < size
    assert len(set(numbers)) == len(numbers)
    assert size < 1.6 * len(places)  # sparse rows, not states times symbols


@pytest.mark.parametrize(("lengths", "total"), [([5, 5, 5], 9), ([1, 100, 100], 51), ([3, 4], 100), ([], 5), ([10], 4)])
def test_even_shares(lengths, total):
    shares = language.even_shares(lengths, total)
    assert sum(shares) == min(total, sum(lengths)) and all(s <= n for s, n in zip(shares, lengths, strict=True))
    assert all(s == n or s >= max(shares) - 1 for s, n in zip(shares, lengths, strict=True))


def test_a_hundred_languages_learn_as_much_each_as_four():
    """Every language has the same bound, and scripts of thousands of letters keep them apart."""
    rng = random.Random(6)
    settings = language.Settings(symbols_per_language=2_000)

    def sample(i):
        letters = [chr(0x4E00 + 31 * i + j) for j in range(300)] if i % 10 == 9 else list("abcdefghijklmnopqrstuvwxyz")
        words = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(60)]
        return [" ".join(rng.choices(words, k=120)) for _ in range(12)], words

    made = {f"l{i:03}": sample(i) for i in range(100)}
    few = language.build_model({n: t for n, (t, _) in list(made.items())[:4]}, settings)
    many = language.build_model({n: t for n, (t, _) in made.items()}, settings)
    assert len(many.languages) == 100 and many.bits.tolist()[:4] == few.bits.tolist()
    assert (many.bits == math.log2(2000)).all()
    assert many.n_symbols > 1500
    texts = [" ".join(rng.choices(words, k=30)) for _, words in made.values()]
    assert language.classify(many, texts)["lang_pred"].tolist() == list(made)


def test_query_accuracy_on_held_out_documents(spark):
    rows = queries.op6_language_id(spark, MEDIUM).toPandas()
    truth = table(spark, MEDIUM, "documents").select("doc_id", "lang").toPandas()
    both = rows.merge(truth, on="doc_id")
    assert len(both) == len(truth)
    held = both[both["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() >= 0.99
    assert both["score"].between(0, 1).all()


def test_awkward_texts_and_columns(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "12 345 !!", 0), (4, "hello there world", 0), (5, "Привет мир " * 9, 0), (None, "hello " * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    model = language.build_model({"en": ["hello world and there you are"], "fr": ["bonjour tout le monde"]})
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, None)] == ["und", "und", "und", "en", "en"]
    assert got[1]["score"] == 0.0
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, None}
    assert language.identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert [r["lang_pred"] for r in language.identify(docs, model).collect()] == ["und", "und"]
