"""Connected components of a link table by alternating stars, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.session import Scratch

MAX_ROUNDS = 60


def _star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of each node below the least node around it."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours below the least of those. Links run from a down to b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple[int, int, int]:
    mark = F.xxhash64("a", "b")
    row = links.agg(
        F.count(F.lit(1)),
        F.sum(F.shiftright(mark, 24)),
        F.sum(mark.bitwiseAND(F.lit((1 << 24) - 1))),
    ).first()
    return tuple(row)


def connected_components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """``node, component`` for every node that a link of ``a, b`` (both BIGINT) touches.

    The component is its least node. Links may come in either direction, repeat, or join a node to
    itself. Each round is two aggregates with a partial step and two joins, so a node with very many
    links is split by the skew join; a star whose centre is known converges in one round.
    """
    oriented = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = scratch.store(oriented.distinct(), f"{name}-0")
    state = _state(current)
    if state[0] == 0:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for turn in range(1, MAX_ROUNDS + 1):
        pulled = _star(current).filter("a <> b").distinct()
        current = scratch.store(_small_star(pulled).distinct(), f"{name}-{turn}")
        following = _state(current)
        if following == state:
            break
        state = following
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
