"""Mixing of sources to target weights: raking of token counts, then sampling.

Documents fall into cells of a cube, one side per margin (source, language, topic). Categories that a
margin does not list, and NULL, share one cell of that side, so the cube holds at most the product of the
listed categories plus one, however many sources the table has; only the cube's sums reach the driver.
Iterative proportional fitting scales the cells until every margin's token shares meet its targets; a
cell's weight is the ratio of fitted to present tokens. A document is kept with its cell's probability. The
probabilities are raked from the weights under the cap of 1, until the tokens they keep meet the budget and,
as far as there are so many, the targets of every margin.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import unit_hash

OTHER = None
ADDED = ("n_tokens", "weight", "probability", "draw", "kept")
# Contradicting margins drive weights apart without end; they stay between this and its inverse.
WEIGHT_LIMIT = 1e30


@dataclass(frozen=True)
class Margin:
    """Target shares of one column's categories. Unlisted categories keep the share they have."""

    column: str
    weights: dict[str, float]


@dataclass(frozen=True)
class Topic:
    """A topic and the pattern that a text of it contains."""

    name: str
    pattern: str


def topic_of(text: Column, topics: Sequence[Topic], default: str) -> Column:
    """The first topic whose pattern occurs; ``default`` where none does, and for NULL."""
    cases = reduce(
        lambda case, t: case.when(text.rlike(t.pattern), t.name), topics[1:], F.when(text.rlike(topics[0].pattern), topics[0].name)
    )
    return cases.otherwise(default)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def rake(cube: np.ndarray, targets: Sequence[np.ndarray], rounds: int = 500, tolerance: float = 1e-9) -> np.ndarray:
    """``cube`` scaled until its sums along every axis have the target shares.

    Targets of categories without tokens are shared out among the others of their margin. Where zeros of
    the cube make the targets contradict each other, the result after ``rounds`` stands.
    """
    fitted = cube.astype(np.float64)
    total = fitted.sum()
    if total == 0:
        return fitted
    axes = range(cube.ndim)
    wanted = []
    for axis, target in enumerate(targets):
        present = cube.sum(axis=tuple(a for a in axes if a != axis)) > 0
        share = np.where(present, target, 0.0)
        if share.sum() == 0:
            share = present.astype(np.float64)
        wanted.append(share / share.sum() * total)
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(wanted):
            sums = fitted.sum(axis=tuple(a for a in axes if a != axis))
            factor = np.divide(target, sums, out=np.zeros_like(target), where=sums > 0)
            worst = max(worst, float(np.abs(sums - target).max()) / total)
            shape = [1] * cube.ndim
            shape[axis] = -1
            fitted = fitted * factor.reshape(shape)
        if worst < tolerance:
            break
    return fitted


def _scale(tokens: np.ndarray, weights: np.ndarray, goal: float) -> float:
    """The ``c`` under which ``min(1, c * weight)`` of the tokens are ``goal``, or all that can be had."""
    order = np.argsort(-weights, kind="stable")
    t, w = tokens[order], weights[order]
    drawn = t * w
    rest = drawn[::-1].cumsum()[::-1]
    capped = t.cumsum() - t
    able = rest > 0
    if not able.any():
        return 0.0
    scales = (goal - capped[able]) / rest[able]
    fits = np.flatnonzero(scales * w[able] <= 1.0)
    return max(0.0, float(scales[fits[0]])) if len(fits) else 1.0 / float(w[able][-1])


def calibrate(tokens: np.ndarray, weights: np.ndarray, budget: float) -> np.ndarray:
    """Probabilities ``min(1, c * weight)`` whose expected tokens are ``budget`` of all, if they can be."""
    return np.minimum(1.0, _scale(tokens, weights, budget * tokens.sum()) * weights)


def _reachable(share: np.ndarray, tokens: np.ndarray, goal: float) -> np.ndarray:
    """Tokens per category that are ``goal`` in all, after ``share`` as far as a category has so many.

    What a category cannot give is shared out among those that can, in proportion to their shares.
    """
    goal = min(goal, float(tokens.sum()))
    share = np.where(tokens > 0, share, 0.0)
    wanted = np.minimum(tokens, share * _scale(tokens, np.divide(share, tokens, out=np.zeros_like(share), where=tokens > 0), goal))
    # Categories of no share are drawn from only when all the others are used up.
    left = np.where(share > 0, 0.0, tokens)
    missing = goal - wanted.sum()
    return wanted + left * (missing / left.sum() if left.sum() > 0 and missing > 1e-9 * goal else 0.0)


def rake_probabilities(
    cube: np.ndarray, weights: np.ndarray, targets: Sequence[np.ndarray], budget: float, rounds: int = 500, tolerance: float = 1e-9
) -> np.ndarray:
    """A probability per cell under which every margin's expected tokens have the target shares of the budget.

    Capping raked weights at 1 would break the margins again. Here every step of the raking knows the cap:
    it scales the weights of one category until ``min(1, weight)`` of its tokens meet the target, and goes
    round until all margins agree. A target above what its category has is met as far as that goes, and the
    rest of its margin takes over. Where margins contradict each other, the round that misses them least stands.
    """
    axes = range(cube.ndim)
    others = [tuple(a for a in axes if a != axis) for axis in axes]
    goal = budget * cube.sum()
    wanted = [_reachable(target, cube.sum(axis=others[axis]), goal) for axis, target in enumerate(targets)]
    weights = np.where(cube > 0, weights, 0.0)
    weights = weights * _scale(cube.ravel(), weights.ravel(), goal)
    best, least = weights, np.inf
    for _ in range(rounds):
        for axis, target in enumerate(wanted):
            for place, tokens in enumerate(target):
                at = (*[slice(None)] * axis, place)
                scaled = weights[at] * _scale(cube[at].ravel(), weights[at].ravel(), float(tokens))
                weights[at] = np.where(weights[at] > 0, np.clip(scaled, 1 / WEIGHT_LIMIT, WEIGHT_LIMIT), 0.0)
        kept = cube * np.minimum(1.0, weights)
        missed = max(float(np.abs(kept.sum(axis=others[axis]) - wanted[axis]).max()) for axis in axes) / goal
        if missed < least:
            best, least = weights.copy(), missed
        if least < tolerance:
            break
    return np.where(cube > 0, np.minimum(1.0, best), budget)


def _targets(cube: np.ndarray, margins: Sequence[Margin]) -> list[np.ndarray]:
    targets = []
    for axis, margin in enumerate(margins):
        sums = cube.sum(axis=tuple(a for a in range(cube.ndim) if a != axis))
        other = sums[-1] / max(1.0, cube.sum())
        listed = np.array(list(margin.weights.values()), dtype=np.float64)
        targets.append(np.append(listed / listed.sum() * (1.0 - other), other))
    return targets


def _place(margin: Margin) -> Column:
    """A category's place on its side of the cube; the last one for all that are not listed."""
    names = list(margin.weights)
    places = F.create_map(*[F.lit(v) for i, n in enumerate(names) for v in (n, i)])
    return F.coalesce(F.try_element_at(places, F.col(margin.column).cast("string")), F.lit(len(names)))


def mix(
    docs: DataFrame, margins: Sequence[Margin], budget: float, tokens: Column, doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``n_tokens, weight, probability, draw, kept`` and, for every margin, ``<column>_target`` and
    ``<column>_expected``: the share that the document's category should have of the tokens that are kept, and the
    share that the probabilities give it. It is less where the category has too few tokens. Columns of
    these names are replaced.

    ``tokens`` counts a document's tokens, ``budget`` is the expected share of all tokens that is kept.
    ``draw`` depends on the id alone, so repeated rows stay or go together and a rerun keeps the same
    documents. Without any token every probability is the budget, as it is in cells without tokens.
    """
    sides = [len(m.weights) + 1 for m in margins]
    cell = reduce(lambda at, p: at * F.lit(p[1]) + p[0], zip([_place(m) for m in margins[1:]], sides[1:], strict=True), _place(margins[0]))
    shares = [f"{m.column}_{kind}" for m in margins for kind in ("target", "expected")]
    kept_columns = [c for c in docs.columns if c not in (*ADDED, *shares, "_cell")]
    counted = docs.select(*kept_columns, cell.alias("_cell"), tokens.cast("long").alias("n_tokens"))
    sums = counted.groupBy("_cell").agg(F.sum("n_tokens")).collect()

    cube = np.zeros(int(np.prod(sides)))
    for place, total in sums:
        cube[place] = total or 0
    cube = cube.reshape(sides)
    targets = _targets(cube, margins)
    fitted = rake(cube, targets)
    weights = np.divide(fitted, cube, out=np.ones_like(cube), where=cube > 0)
    chances = rake_probabilities(cube, weights, targets, budget) if cube.sum() > 0 else np.full(cube.shape, budget)
    expected = cube * chances / max(1e-300, float((cube * chances).sum()))

    def at(place: Column, values: np.ndarray) -> Column:
        return F.element_at(F.lit([float(v) for v in values.ravel()]), place + 1)

    added = {"weight": at(F.col("_cell"), weights), "probability": at(F.col("_cell"), chances)}
    for axis, (margin, target) in enumerate(zip(margins, targets, strict=True)):
        reached = expected.sum(axis=tuple(a for a in range(cube.ndim) if a != axis))
        added[f"{margin.column}_target"] = at(_place(margin), target)
        added[f"{margin.column}_expected"] = at(_place(margin), reached)
    added["draw"] = unit_hash(F.lit("mixing"), F.col(doc_id))
    weighed = counted.withColumns(added)
    return weighed.withColumn("kept", F.col("draw") < F.col("probability")).drop("_cell")
