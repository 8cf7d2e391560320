"""Raking against its defining sums, and the sample against its probabilities."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstar.llm import mixing, queries
from ledgerstar.sources.tables import table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_raked_margins_meet_their_targets():
    cube = np.random.default_rng(1).uniform(1, 9, size=(4, 3, 2))
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.9, 0.1])]
    fitted = mixing.rake(cube, targets)
    for axis, target in enumerate(targets):
        sums = fitted.sum(axis=tuple(a for a in range(3) if a != axis)) / fitted.sum()
        assert np.allclose(sums, target, atol=1e-8)
    # the odds ratios of the cube stay as they were
    ratio = lambda c: c[0, 0, 0] * c[1, 1, 0] / (c[0, 1, 0] * c[1, 0, 0])
    assert ratio(fitted) == pytest.approx(ratio(cube))


def test_calibration_meets_the_budget():
    tokens = np.array([100.0, 50.0, 10.0, 0.0])
    weights = np.array([0.5, 1.0, 9.0, 1.0])
    chances = mixing.calibrate(tokens, weights, 0.4)
    assert chances.max() <= 1.0
    assert (tokens * chances).sum() == pytest.approx(64.0)
    assert mixing.calibrate(tokens, weights, 1.0) == pytest.approx([1, 1, 1, 1])


def margins_of(cube):
    return [cube.sum(axis=tuple(a for a in range(cube.ndim) if a != axis)) / cube.sum() for axis in range(cube.ndim)]


def test_probabilities_meet_the_margins_under_the_cap():
    cube = np.random.default_rng(2).uniform(1, 9, size=(5, 4, 3))
    cube[0, 0, 0] = 0
    targets = [np.array([0.35, 0.3, 0.2, 0.1, 0.05]), np.array([0.4, 0.2, 0.2, 0.2]), np.array([0.5, 0.3, 0.2])]
    weights = np.divide(mixing.rake(cube, targets), cube, out=np.ones_like(cube), where=cube > 0)
    chances = mixing.rake_probabilities(cube, weights, targets, 0.35)
    capped = np.isclose(chances, 1.0) & (cube > 0)
    assert capped.any() and chances.max() <= 1.0
    kept = cube * chances
    assert kept.sum() == pytest.approx(0.35 * cube.sum())
    for share, target in zip(margins_of(kept), targets, strict=True):
        assert np.allclose(share, target, atol=1e-8)
    # capping the raked weights alone misses them
    plain = cube * mixing.calibrate(cube.ravel(), weights.ravel(), 0.35).reshape(cube.shape)
    assert max(np.abs(s - t).max() for s, t in zip(margins_of(plain), targets, strict=True)) > 0.005


def test_probabilities_under_the_cap_are_the_nearest_to_the_present_ones():
    # two margins, found by a plain minimiser: the sum of p log p - p over tokens, along the free directions
    cube = np.array([[8.0, 1.0, 3.0], [2.0, 6.0, 4.0]])
    targets = [np.array([0.7, 0.3]), np.array([0.5, 0.2, 0.3])]
    weights = mixing.rake(cube, targets) / cube
    chances = mixing.rake_probabilities(cube, weights, targets, 0.5)
    kept = cube * chances

    def divergence(x):
        return float((x * np.log(x / cube) - x).sum())

    free = [np.array([[1, -1, 0], [-1, 1, 0]]), np.array([[0, 1, -1], [0, -1, 1]]), np.array([[1, 0, -1], [-1, 0, 1]])]
    for step in [s * sign * 1e-4 for s in free for sign in (1.0, -1.0)]:
        moved = kept + step
        if (moved <= cube + 1e-12).all() and (moved > 0).all():
            assert divergence(moved) >= divergence(kept) - 1e-10


def test_targets_out_of_reach_go_to_the_rest_of_their_margin():
    cube = np.array([[10.0, 10.0], [45.0, 35.0]])
    targets = [np.array([0.6, 0.4]), np.array([0.5, 0.5])]
    weights = mixing.rake(cube, targets) / cube
    kept = cube * mixing.rake_probabilities(cube, weights, targets, 0.5)
    rows, columns = margins_of(kept)
    assert kept.sum() == pytest.approx(50) and np.allclose(rows, [0.4, 0.6]) and np.allclose(columns, [0.5, 0.5])
    # margins that contradict each other: all there is of the scarce cell, finite and at most 1
    apart = np.array([[10.0, 0.0], [0.0, 90.0]])
    chances = mixing.rake_probabilities(apart, np.ones((2, 2)), [np.array([0.1, 0.9]), np.array([0.9, 0.1])], 0.5)
    assert np.isfinite(chances).all() and chances.min() >= 0 and chances.max() <= 1
    everything = mixing.rake_probabilities(cube, weights, targets, 1.0)
    assert np.allclose(everything, 1.0)


def test_query_against_plain_numpy(spark):
    rows = queries.op1_source_mixing(spark, MEDIUM).toPandas()
    docs = table(spark, MEDIUM, "documents").toPandas()
    words = docs.set_index("doc_id")["text"].str.split().str.len()
    assert (rows.set_index("doc_id")["n_tokens"] == words).all()
    assert rows["doc_id"].is_unique and len(rows) == len(docs)
    assert ((rows["draw"] < rows["probability"]) == rows["kept"]).all()
    # weights bring each margin to its targets
    weighted = rows["n_tokens"] * rows["weight"]
    for margin in queries.MIXTURE:
        shares = weighted.groupby(rows[margin.column]).sum() / weighted.sum()
        wanted = {k: v / sum(margin.weights.values()) for k, v in margin.weights.items()}
        for name, share in shares.items():
            assert share == pytest.approx(wanted[name], abs=1e-6)
    assert (rows["n_tokens"] * rows["probability"]).sum() == pytest.approx(0.5 * rows["n_tokens"].sum())
    # and probabilities keep these shares, but for categories that have too few tokens
    expected = rows["n_tokens"] * rows["probability"]
    for margin in queries.MIXTURE:
        shares = expected.groupby(rows[margin.column]).sum() / expected.sum()
        have = rows.groupby(margin.column)["n_tokens"].sum() / expected.sum()
        told = rows.groupby(margin.column)[[f"{margin.column}_target", f"{margin.column}_expected"]].first()
        assert np.allclose(told[f"{margin.column}_expected"], shares, atol=1e-9)
        short = have < told[f"{margin.column}_target"]
        assert np.allclose(shares[short], have[short], atol=1e-6)
        if not short.any():
            assert np.allclose(shares, told[f"{margin.column}_target"], atol=1e-6)
    kept = rows.loc[rows["kept"], "n_tokens"].sum() / rows["n_tokens"].sum()
    assert 0.42 < kept < 0.58


def test_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, 9.0), (2, "", "src1", "xx", 9.0), (None, "a b", "s", "en", 9.0), (1, "x " * 50_000, "src2", "en", 9.0)] * 2,
        "doc_id bigint, text string, source string, lang string, weight double",
    )
    rows = queries.mixed(docs).collect()
    assert len(rows) == 8
    assert {r["n_tokens"] for r in rows} == {0, 2, 50_000}
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert all(r["topic"] == "prose" for r in rows)
    assert queries.mixed(docs.limit(0)).count() == 0
    wordless = docs.filter(F.coalesce("text", F.lit("")) == "")
    assert {r["probability"] for r in queries.mixed(wordless).collect()} == {queries.TOKEN_BUDGET}
