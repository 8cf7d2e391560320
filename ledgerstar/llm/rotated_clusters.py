"""Clusters around integer centroids, with candidates filtered in PCA-rotated space.

Components become whole numbers, so every distance, sum and mean is exact and no result depends on how
the rows are dealt. For speed each vector also carries a short form: its ``leading`` coordinates along the
principal axes of the whole table, and the norm of the rest. The projected distance plus the squared
difference of the two rest norms never exceeds the true squared distance, so a centroid whose bound is
above the exact distance to the most promising one is left out; the survivors are compared in integers.
The axes come from the second moments of all vectors, summed up in tasks; their rounding errors
widen the bounds and change nothing in the result.

Each round folds counts and sums per centroid inside a task, so a row for each task and centroid is
shuffled, whatever their sizes; a few whole numbers come back.

Defined cases: vectors that are NULL, of another dimension, or hold a NULL or non-finite component are left
out. Components must stay below 2**27 in whole numbers, or else no distance would fit a BIGINT: such a
table is refused with an error. Rows that repeat an id are vectors of their own. A NULL id is never among the
first centroids. Fewer vectors than centroids give as many centroids as vectors; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.session import Scratch, small_frame

MAX_WHOLE = 1 << 27
ROWS_AT_ONCE = 8192
# Far above what rounding in double precision can add to a bound, relative to the norms it is made of.
SLACK = 1e-9


@dataclass(frozen=True)
class Axes:
    """The centre of all vectors and the first principal directions, a row each, then all others."""

    centre: np.ndarray
    directions: np.ndarray
    leading: int

    def short_form(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the rest for each row."""
        turned = (whole - self.centre) @ self.directions.T
        return turned[:, : self.leading], np.linalg.norm(turned[:, self.leading :], axis=1)


def whole_vectors(vectors: DataFrame, dims: int, scale: int, vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: the usable vectors in whole numbers."""
    value = F.col(vector).cast("array<double>")
    usable = (F.size(value) == dims) & F.forall(
        value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    held = vectors.filter(F.coalesce(usable, F.lit(False))).select("vec_id", value.alias("_v"))

    def whole(x):
        fits = F.abs(x) < float(MAX_WHOLE // scale)
        return F.when(fits, F.floor(x * float(scale))).otherwise(F.raise_error(F.lit("a component is too large")))

    return held.select("vec_id", F.transform("_v", whole).cast("array<int>").alias("v"))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _sum_by_place(lists: DataFrame, *keys: str) -> list:
    """Sums of the lists' entries over all rows, one row a key and place."""
    placed = lists.select(*keys, F.posexplode("sums").alias("place", "x"))
    return placed.groupBy(*keys, "place").agg(F.sum("x").alias("x")).collect()


def principal_axes(whole: DataFrame, dims: int, leading: int) -> Axes:
    """Axes from the moments of all rows; dims * (dims + 1) + 1 numbers come back."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dims + dims * dims)
        for batch in _chunks(batches):
            rows = _rows(batch["v"], dims).astype(np.float64)
            total += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])

    sums = np.zeros(1 + dims + dims * dims)
    for row in _sum_by_place(whole.select("v").mapInArrow(moments, "sums array<double>")):
        sums[row.place] = row.x
    count = max(sums[0], 1.0)
    centre = sums[1 : dims + 1] / count
    spread = sums[dims + 1 :].reshape(dims, dims) / count - np.outer(centre, centre)
    _, directions = np.linalg.eigh((spread + spread.T) / 2)
    return Axes(centre, directions.T[::-1].copy(), leading)


def with_short_form(whole: DataFrame, axes: Axes, dims: int) -> DataFrame:
    """``vec_id, v`` beside ``lead`` and ``rest``."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            lead, rest = axes.short_form(_rows(batch["v"], dims))
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * axes.leading)
            columns = [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(lead.ravel())), pa.array(rest)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "lead", "rest"])

    id_type = whole.schema["vec_id"].dataType.simpleString()
    return whole.mapInArrow(turn, f"vec_id {id_type}, v array<int>, lead array<double>, rest double")


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


class Centroids:
    """Whole-number centroids with their short forms."""

    def __init__(self, whole: list[list[int]], axes: Axes):
        self.whole = np.array(whole, dtype=np.int64)
        self.lead, self.rest = axes.short_form(self.whole)

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """For each row and centroid a number that the squared distance is not below."""
        projected = ((lead[:, None, :] - self.lead[None]) ** 2).sum(axis=2)
        bound = projected + (rest[:, None] - self.rest[None]) ** 2
        norms = ((lead**2).sum(axis=1) + rest**2)[:, None] + ((self.lead**2).sum(axis=1) + self.rest**2)[None]
        return bound - SLACK * norms

    def nearest(self, rows: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid, of equally near ones the smaller number, and the exact squared distance."""
        bounds = self.bounds(lead, rest)
        likely = bounds.argmin(axis=1)
        best = _exact(rows, self.whole[likely])
        row, number = np.nonzero(bounds <= best[:, None])
        distance = np.full(bounds.shape, np.iinfo(np.int64).max)
        distance[row, number] = _exact(rows[row], self.whole[number])
        distance[np.arange(len(rows)), likely] = best
        cluster = distance.argmin(axis=1)
        return cluster, distance[np.arange(len(rows)), cluster]


def _assigned(batch: pa.RecordBatch, centroids: Centroids, dims: int, leading: int):
    rows = _rows(batch["v"], dims).astype(np.int64)
    return rows, *centroids.nearest(rows, _rows(batch["lead"], leading), np.asarray(batch["rest"]))


def moved(turned: DataFrame, whole: list[list[int]], axes: Axes, dims: int) -> list[list[int]]:
    """The centroids after one round over all vectors; a centroid without vectors stays."""
    centroids = Centroids(whole, axes)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(whole), dims + 1), dtype=np.int64)
        for batch in _chunks(batches):
            rows, cluster, _ = _assigned(batch, centroids, dims, axes.leading)
            for number in np.unique(cluster):
                members = rows[cluster == number]
                sums[number] += np.append(members.sum(axis=0), len(members))
        used = np.flatnonzero(sums[:, -1])
        lists = pa.array([sums[n].tolist() for n in used], type=pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), lists], ["cluster", "sums"])

    folded = turned.select("v", "lead", "rest").mapInArrow(fold, "cluster int, sums array<bigint>")
    sums = [[0] * (dims + 1) for _ in whole]
    for row in _sum_by_place(folded, "cluster"):
        sums[row.cluster][row.place] = int(row.x)
    return [[x // s[-1] for x in s[:-1]] if s[-1] else old for s, old in zip(sums, whole, strict=True)]


def cluster(
    vectors: DataFrame,
    clusters: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    salt: str = "3:",
    leading: int = 8,
    vector: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` for each usable vector.

    The first centroids are the vectors whose salted id has the smallest SHA-256. ``centroid`` is the
    final one's list of whole numbers. Rounds end early once nothing moves.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    whole = scratch.store(whole_vectors(vectors, dims, scale, vector), "whole")
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = whole.filter(digest.isNotNull()).orderBy(digest, "v").limit(clusters).collect()
    centroids = [list(row.v) for row in first]
    id_type = whole.schema["vec_id"].dataType.simpleString()
    if not centroids:
        return spark.createDataFrame(
            [], f"vec_id {id_type}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
        )
    axes = principal_axes(whole, dims, leading)
    turned = scratch.store(with_short_form(whole, axes, dims), "turned")
    for _ in range(rounds):
        following = moved(turned, centroids, axes, dims)
        if following == centroids:
            break
        centroids = following
    final = Centroids(centroids, axes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            _, number, distance = _assigned(batch, final, dims, leading)
            columns = [batch["vec_id"], pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    placed = scratch.store(turned.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance bigint"), "placed")
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    described = [(n, sums.get(n, 0), sum(sums.values()), [int(x) for x in c]) for n, c in enumerate(centroids)]
    table = small_frame(spark, described, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    # One row a centroid.
    return placed.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def centroid_digest(whole: list[int]) -> str:
    """The digest of one centroid's numbers, as the query reports it."""
    return hashlib.sha256(",".join(map(str, whole)).encode()).hexdigest()
