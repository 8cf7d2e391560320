"""Toxicity classifier, regularised by counterfactual sentences.

A text's features are the words in it and the beginnings of its words, present or not. Weights are those
of a logistic regression that is also penalised for every change of the logit when an identity term in a
labelled sentence is swapped for another of its group, or for a neutral noun. Where one group is named
more often in toxic text, an unpenalised model learns the name; this one cannot, so neutral mentions of
that group keep low scores.

Fitting looks at a bounded sample of labelled rows. Feature counts, features of the sample's rows and the
distinct swaps come from Spark jobs over that sample; the driver solves for at most ``max_features`` weights.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import labelled_sample
from ledgerstar.session import Scratch

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")
LONGEST_WORD = 64
CACHED_WORDS = 200_000

# Terms of one group may stand for one another.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "locals"),
    ("german", "french", "spanish", "english"),
)
NEUTRAL = "people"


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` and ``max_features`` bound the fit; scores always read whole texts."""

    rows_per_class: int = 5000
    max_features: int = 1536
    least_documents: int = 4
    least_chi_square: float = 12.0
    ridge: float = 0.5
    counterfactual: float = 50.0
    prefixes: tuple[int, ...] = (3, 4, 5, 6, 7, 8, 9)


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    intercept: float
    prefixes: tuple[int, ...]


def words_of(text: str) -> set[str]:
    return {w[:LONGEST_WORD] for w in WORD.findall(text.lower())}


def features_of(word: str, prefixes: tuple[int, ...]) -> list[str]:
    """The word, marked as whole, and its beginnings."""
    return [f"{word}$", *(word[:k] for k in prefixes if len(word) >= k)]


def text_features(text: str, prefixes: tuple[int, ...]) -> set[str]:
    return {f for w in words_of(text) for f in features_of(w, prefixes)}


def swaps_of(text: str, groups=IDENTITY_GROUPS, neutral: str = NEUTRAL) -> Iterator[tuple[set[str], set[str]]]:
    """For each sentence with an identity term: its words, and its words with the term swapped."""
    partners = {t: [*(o for o in group if o != t), neutral] for group in groups for t in group}
    for sentence in SENTENCE.split(text.lower()):
        words = words_of(sentence)
        for term in sorted(words & partners.keys()):
            for other in partners[term]:
                yield words, (words - {term}) | {other}


def _feature_counts(sample: DataFrame, label: str, prefixes: tuple[int, ...]) -> DataFrame:
    """``feature, positive, negative``: documents of either label that hold it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for rows in batches:
            for text, value in zip(rows["text"], rows["y"], strict=True):
                found[int(value)].update(text_features(text, prefixes))
        names = list(found[0].keys() | found[1].keys())
        yield pd.DataFrame({"feature": names, "positive": [found[1][n] for n in names], "negative": [found[0][n] for n in names]})

    parts = sample.mapInPandas(count, "feature string, positive bigint, negative bigint")
    return parts.groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def _chi_square(positives: int, negatives: int) -> Column:
    """Chi-square of holding the feature against the label, with the continuity correction."""
    a, b = F.col("positive"), F.col("negative")
    c, d = F.lit(positives) - a, F.lit(negatives) - b
    n = positives + negatives
    gap = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0))
    spread = (a + b).cast("double") * (c + d) * positives * negatives
    return F.when(spread > 0, n * gap * gap / spread).otherwise(0.0)


def _encoded(sample: DataFrame, places: dict[str, int], settings: Settings, groups) -> DataFrame:
    """``y, ids, swaps`` of each row; a swap is what it adds and what it takes away."""

    def ids(words: set[str]) -> set[int]:
        return {places[f] for w in words for f in features_of(w, settings.prefixes) if f in places}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            swaps = []
            for text in rows["text"]:
                pairs = [(ids(after) - ids(before), ids(before) - ids(after)) for before, after in swaps_of(text, groups)]
                swaps.append([{"added": sorted(x), "taken": sorted(y)} for x, y in pairs if x or y])
            yield pd.DataFrame({"y": rows["y"], "ids": [sorted(ids(words_of(t))) for t in rows["text"]], "swaps": swaps})

    return sample.mapInPandas(encode, "y int, ids array<int>, swaps array<struct<added array<int>, taken array<int>>>")


def solve(
    x: np.ndarray, y: np.ndarray, changes: np.ndarray, shares: np.ndarray, ridge: float, counterfactual: float
) -> tuple[np.ndarray, float]:
    """Newton steps for the mean logistic loss, a ridge, and the mean squared change of the logit."""
    n, k = x.shape
    weighted = changes * np.sqrt(shares)[:, None]
    penalty = counterfactual * (weighted.T @ weighted) + ridge / max(1, n) * np.eye(k)
    w, b = np.zeros(k), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))

    def loss(w, b):
        z = x @ w + b
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5 * w @ penalty @ w)

    now = loss(w, b)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        error, curve = (p - y) / n, np.maximum(p * (1 - p), 1e-6) / n
        gradient = np.append(x.T @ error + penalty @ w, error.sum())
        hessian = np.zeros((k + 1, k + 1))
        for at in range(0, n, 2048):
            part = x[at : at + 2048].astype(np.float64)
            hessian[:k, :k] += part.T @ (part * curve[at : at + 2048, None])
        hessian[:k, :k] += penalty
        hessian[:k, k] = hessian[k, :k] = x.T @ curve
        hessian[k, k] = curve.sum() + 1e-9
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step[:k], b - size * step[k]) > now:
            size /= 2
        w, b = w - size * step[:k], b - size * step[k]
        before, now = now, loss(w, b)
        if before - now < 1e-9:
            break
    return w, float(b)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    groups=IDENTITY_GROUPS,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
) -> ToxicityModel:
    """Fit on a bounded, class-balanced sample of the texts of ``docs`` whose key has a 0 or 1 in
    ``labels``; the intercept is set back to the labels' true shares. Without texts of both labels the
    model gives every text the share of ones."""
    scratch = Scratch(docs.sparkSession)
    chosen, shares = labelled_sample(docs, labels, label, settings.rows_per_class, text, key)
    sample = scratch.store(chosen.select("text", "y").repartition(16), "sample")
    counts = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if len(counts) < 2:
        scratch.drop()
        share = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1.0)
        return ToxicityModel({}, float(np.log(share / (1 - share))), settings.prefixes)
    chi = _chi_square(counts[1], counts[0])
    seen = _feature_counts(sample, "y", settings.prefixes).filter(F.col("positive") + F.col("negative") >= settings.least_documents)
    best = seen.withColumn("chi", chi).filter(F.col("chi") >= settings.least_chi_square)
    names = [r[0] for r in best.orderBy(F.desc("chi"), "feature").limit(settings.max_features).collect()]
    places = {name: i for i, name in enumerate(names)}

    coded = scratch.store(_encoded(sample, places, settings, groups), "coded")
    rows = coded.select("y", "ids").collect()
    y = np.array([r[0] for r in rows], dtype=np.float64)
    x = np.zeros((len(rows), len(names)), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row[1]] = 1
    swaps = coded.select(F.explode("swaps").alias("s")).groupBy("s").count().orderBy(F.desc("count"), "s").collect()
    changes = np.zeros((len(swaps), len(names)))
    for i, row in enumerate(swaps):
        changes[i, row[0]["added"]] += 1
        changes[i, row[0]["taken"]] -= 1
    weight = np.array([r[1] for r in swaps], dtype=np.float64)
    w, b = solve(x, y, changes, weight / max(1.0, weight.sum()), settings.ridge, settings.counterfactual)
    b += np.log(shares[1] / shares[0]) - np.log(counts[1] / counts[0])
    kept = {n: float(v) for n, v in zip(names, w, strict=True) if abs(v) > 1e-6}
    scratch.drop()
    return ToxicityModel(kept, float(b), settings.prefixes)


class Scorer:
    """Scores texts; remembers which features a word has."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.known: dict[str, tuple[str, ...]] = {}

    def score(self, text: str | None) -> float:
        present: set[str] = set()
        known, weights = self.known, self.model.weights
        for word in words_of(text or ""):
            features = known.get(word)
            if features is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                features = tuple(f for f in features_of(word, self.model.prefixes) if f in weights)
                known[word] = features
            present.update(features)
        logit = self.model.intercept + sum(weights[f] for f in sorted(present))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def toxicity_of(model: ToxicityModel, text: Column, spark) -> Column:
    """The score of a text column, 0 to 1; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return score(text)
