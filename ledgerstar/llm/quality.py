"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``passage_chars`` characters; its label says nothing of single
passages. Each passage is encoded from counts of its characters and words, ``h = tanh(W x + b)``. Gated
attention ``w . (tanh(V h) * sigmoid(U h))`` weighs the passages of a document against each other, and
the weighted mean of their codes gives the document's score by a logistic function. All weights are learned
together from document labels alone.

Every passage of a text is encoded, however long the text is. Fitting uses a bounded sample of labelled
rows; their passages are encoded by Spark tasks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import labelled_sample
from ledgerstar.session import Scratch

LOWER, UPPER, OTHER_LETTER, DIGIT, SPACE, BREAK, STOP, SHOUT, BAR, SYMBOL = range(10)
N_CLASSES = 10
STOPS = ".,;:?'\"()-"
N_FEATURES = N_CLASSES + 8


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` and ``max_passages`` bound the fit only."""

    rows_per_class: int = 3000
    max_passages: int = 120_000
    passage_chars: int = 512
    codes: int = 24
    attention: int = 16
    steps: int = 300
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 3


@dataclass(frozen=True)
class QualityModel:
    classes: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    passage_chars: int


def character_classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, SYMBOL, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            table[i] = LOWER if kind == "Ll" else UPPER if kind in ("Lu", "Lt") else OTHER_LETTER
        elif kind[0] == "M":
            table[i] = OTHER_LETTER
        elif kind[0] == "N":
            table[i] = DIGIT
        elif kind[0] == "Z" or chr(i).isspace():
            table[i] = SPACE
    table[ord("\n")] = BREAK
    for c in STOPS:
        table[ord(c)] = STOP
    table[ord("!")], table[ord("|")] = SHOUT, BAR
    return table


def encode(texts: list[str], classes: np.ndarray, passage_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the text each belongs to; an empty text has one passage of zeros."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    per_text = np.maximum(1, -(-lengths // passage_chars))
    owner = np.repeat(np.arange(len(texts)), per_text)
    first = np.cumsum(per_text) - per_text
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start_of = np.cumsum(lengths) - lengths
    text_of = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(points)) - start_of[text_of]
    passage = first[text_of] + place // passage_chars
    kind = classes[points]
    n = len(owner)
    counts = np.bincount(passage * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float64)
    chars = np.maximum(1, counts.sum(axis=1))

    # A word is a run of characters other than white space, cut where its passage ends.
    solid = (kind != SPACE) & (kind != BREAK)
    opens = solid.copy()
    if len(points):
        opens[1:] &= ~solid[:-1] | (passage[1:] != passage[:-1])
    at = np.flatnonzero(opens)
    words = np.bincount(passage[at], minlength=n).astype(np.float64)
    total = np.maximum(1, words)
    extra = np.zeros((n, 8))
    if len(at):
        inside = np.flatnonzero(solid)
        word_of = np.cumsum(opens)[inside] - 1
        offset = (inside - at[word_of]).astype(np.uint64)
        mixed = (points[inside].astype(np.uint64) + np.uint64(1)) * (offset * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
        mixed ^= mixed >> np.uint64(29)
        starts = np.flatnonzero(np.concatenate([[True], word_of[1:] != word_of[:-1]]))
        key = np.add.reduceat(mixed, starts)
        size = np.diff(np.append(starts, len(inside)))
        last = kind[inside[np.append(starts[1:], len(inside)) - 1]]
        where = passage[at]

        def share(flag: np.ndarray, rows: np.ndarray = where) -> np.ndarray:
            return np.bincount(rows, weights=flag, minlength=n) / total

        for lag, column in ((1, 0), (2, 1)):
            if len(key) > lag:
                same = (key[lag:] == key[:-lag]) & (where[lag:] == where[:-lag])
                extra[:, column] = share(same.astype(np.float64), where[lag:])
        order = np.lexsort((key, where))
        new = np.ones(len(key))
        new[1:] = (key[order][1:] != key[order][:-1]) | (where[order][1:] != where[order][:-1])
        extra[:, 2] = share(new, where[order])
        extra[:, 3] = share(((last == SYMBOL) | (last == SHOUT)).astype(np.float64))
        extra[:, 4] = share((last == STOP).astype(np.float64))
        extra[:, 5] = share(size.astype(np.float64)) / 10
        extra[:, 6] = share((size > 24).astype(np.float64))
    extra[:, 7] = np.log1p(words) / 5
    return np.hstack([counts / chars[:, None], extra]), owner


def _segments(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))


def forward(w: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    """Codes, attention and logits; ``owner`` is sorted and every document has a passage."""
    starts = _segments(owner)
    h = np.tanh(x @ w["W"] + w["b"])
    t = np.tanh(h @ w["V"] + w["v"])
    g = 1 / (1 + np.exp(-(h @ w["U"] + w["u"])))
    energy = (t * g) @ w["a"]
    energy = np.exp(energy - np.maximum.reduceat(energy, starts)[owner])
    attention = energy / np.add.reduceat(energy, starts)[owner]
    z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
    return {"starts": starts, "h": h, "t": t, "g": g, "attention": attention, "z": z, "logit": z @ w["c"] + w["d"]}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean logistic loss, by every weight."""
    f = forward(w, x, owner)
    error = (1 / (1 + np.exp(-np.clip(f["logit"], -30, 30))) - y) / len(y)
    dz = (error[:, None] * w["c"])[owner]
    a, h, t, g = f["attention"], f["h"], f["t"], f["g"]
    da = (dz * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, f["starts"])[owner])
    dtg = de[:, None] * w["a"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
    return {
        "c": f["z"].T @ error, "d": error.sum(), "a": (t * g).T @ de,
        "V": h.T @ dt, "v": dt.sum(axis=0), "U": h.T @ dg, "u": dg.sum(axis=0),
        "W": x.T @ dh, "b": dh.sum(axis=0),
    }


def train(x: np.ndarray, owner: np.ndarray, y: np.ndarray, settings: Settings) -> dict[str, np.ndarray]:
    """Weights by adaptive gradient steps over all bags."""
    rng = np.random.default_rng(settings.seed)
    k, m = settings.codes, settings.attention
    w = {
        "W": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], k)), "b": np.zeros(k),
        "V": rng.normal(0, k**-0.5, (k, m)), "v": np.zeros(m),
        "U": rng.normal(0, k**-0.5, (k, m)), "u": np.zeros(m),
        "a": rng.normal(0, m**-0.5, m), "c": rng.normal(0, k**-0.5, k),
        "d": np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)),
    }
    first = {n: np.zeros_like(v) for n, v in w.items()}
    second = {n: np.zeros_like(v) for n, v in w.items()}
    for step in range(1, settings.steps + 1):
        rate = settings.rate * (1 - step / (settings.steps + 1))
        for name, slope in gradients(w, x, owner, y).items():
            slope = slope + settings.decay * w[name]
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope * slope
            scale = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
            w[name] = w[name] - rate * first[name] / (1 - 0.9**step) / scale
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    text: str = "text",
    label: str = "quality",
    key: str = "doc_id",
) -> QualityModel:
    """Fit on a bounded, class-balanced sample of the texts of ``docs`` whose key has a 0 or 1 in
    ``labels``; the intercept is set back to the labels' true shares. Without texts of both labels the
    model gives every text the share of ones."""
    scratch = Scratch(docs.sparkSession)
    classes = character_classes()
    sample, shares = labelled_sample(docs, labels, label, settings.rows_per_class, text, key)
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x, owner = encode(rows["text"].tolist(), shared.value, settings.passage_chars)
            bags = np.split(x, _segments(owner)[1:])
            yield pd.DataFrame({"y": rows["y"], "place": rows["place"], "bag": [b.astype(np.float32).tobytes() for b in bags]})

    placed = sample.select("text", "y", F.xxhash64("key", "text").alias("place")).repartition(16)
    coded = scratch.store(placed.mapInPandas(encoded, "y int, place bigint, bag binary"), "bags")
    rows = coded.withColumn("n", F.octet_length("bag") / (4 * N_FEATURES)).orderBy("place", "y")
    bags, y, n = [], [], 0
    for row in rows.select("y", "bag", "n").toLocalIterator():
        if n + row["n"] > settings.max_passages and len(set(y)) == 2:
            break
        bags.append(np.frombuffer(row["bag"], dtype=np.float32).reshape(-1, N_FEATURES))
        y.append(row["y"])
        n += row["n"]
    if len(set(y)) < 2:
        scratch.drop()
        share = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1.0)
        return QualityModel(classes, np.full(1, np.log(share / (1 - share))), np.ones(1), {}, settings.passage_chars)
    x = np.vstack(bags).astype(np.float64)
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    y = np.array(y, dtype=np.float64)
    weights = train((x - mean) / spread, owner, y, settings)
    weights["d"] = weights["d"] + np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum()))
    scratch.drop()
    return QualityModel(classes, mean, spread, weights, settings.passage_chars)


def scores(model: QualityModel, texts: list[str | None], at_once: int = 2 << 20) -> np.ndarray:
    """Scores of texts, encoded in groups of about ``at_once`` characters."""
    if not model.weights:
        return np.full(len(texts), 1 / (1 + np.exp(-model.mean[0])))
    out = np.empty(len(texts))
    sizes = np.cumsum([len(t or "") for t in texts])
    first = 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, done + at_once, side="right")))
        x, owner = encode([t or "" for t in texts[first:last]], model.classes, model.passage_chars)
        logit = forward(model.weights, (x - model.mean) / model.spread, owner)["logit"]
        out[first:last] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        first = last
    return out


def quality_of(model: QualityModel, text: Column, spark) -> Column:
    """The score of a text column, 0 to 1; NULL counts as empty."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores(shared.value, [t if isinstance(t, str) else None for t in texts]), dtype="float64")

    return score(text)
