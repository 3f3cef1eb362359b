"""Centroid clustering of integer vectors with an incremental distance matrix.

A vector keeps its exact dot products with all centroids in the written table. The squared distance
to a centroid c is |x|^2 - 2 x.c + |c|^2, so after a round only the components of centroids that
changed are multiplied again and added to the products; then the nearest centroid is looked up anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import remove, stored_at

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Components must be within this bound, so that a distance over ``DIMENSIONS`` fits a long.
LIMIT = 1 << 27
MATRIX = "vec_id bigint, x array<int>, dots array<bigint>, cluster int, distance bigint"
_NAMES = [c.split()[0] for c in MATRIX.split(", ")]
#: Vectors multiplied at once.
SLICE = 4096


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors with exactly ``dimensions`` components, none NULL or non-finite;
    x is floor(scale * component). A component beyond ``LIMIT`` is an error, not a wrong distance."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    infinite = F.lit(float("inf"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    checked = F.transform(
        "v",
        lambda c: F.when(F.abs(c * float(scale)) < float(LIMIT), F.floor(c * float(scale)).cast("int"))
        .otherwise(F.raise_error(F.lit(f"a component is not within {LIMIT} after scaling")).cast("int")),
    )
    return own.where((F.size("v") == dimensions) & good).select("vec_id", checked.alias("x"))


def _rows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width).astype(np.int64)


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in that order; all that have an id, if fewer."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = whole.where("vec_id IS NOT NULL").withColumn("_key", key).orderBy("_key", "x").limit(k).collect()
    return np.array([r.x for r in top], np.int64)


def _updated(vectors: DataFrame, centroids: np.ndarray, change: np.ndarray | None) -> DataFrame:
    """Rows of ``MATRIX`` for these centroids. ``change`` is what was added to the centroids that the
    rows' products are with; None: there are no products yet."""
    lengths = (centroids * centroids).sum(1)
    width, k = centroids.shape[1], len(centroids)
    moved = [] if change is None else [(j, np.flatnonzero(row)) for j, row in enumerate(change) if row.any()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), SLICE):
                batch = whole.slice(a, SLICE)
                x = _rows(batch, "x", width)
                if change is None:
                    dots = x @ centroids.T
                else:
                    dots = _rows(batch, "dots", k)
                    for j, parts in moved:
                        dots[:, j] += x[:, parts] @ change[j, parts]
                away = lengths - 2 * dots
                nearest = away.argmin(1)
                distance = (x * x).sum(1) + away[np.arange(len(x)), nearest]
                made = [
                    batch.column("vec_id"),
                    batch.column("x"),
                    _lists(dots),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distance),
                ]
                yield pa.RecordBatch.from_arrays(made, _NAMES)

    return vectors.mapInArrow(run, MATRIX)


def _lists(matrix: np.ndarray) -> pa.Array:
    bounds = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(matrix.reshape(-1)))


def _moved(matrix: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The componentwise floor of the mean of each centroid's vectors; a centroid without any stays.

    A task adds up what it reads, so at most a row per task, centroid and component is shuffled, and
    one per centroid and component comes to the driver.
    """
    k, width = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, cluster = _rows(batch, "x", width), batch.column("cluster").to_numpy()
            for j in np.unique(cluster):
                own = x[cluster == j]
                sums[j] += own.sum(0)
                counts[j] += len(own)
        for j in np.flatnonzero(counts):
            columns = [np.full(width, j), np.arange(width), sums[j], np.full(width, counts[j])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "part", "total", "n"])

    parts = matrix.select("x", "cluster").mapInArrow(run, "cluster bigint, part bigint, total bigint, n bigint")
    totals = parts.groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in totals.collect():
        out[row.cluster, row.part] = row.total // row.n
    return out


def clustered(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids.

    Kept are vectors of ``dimensions`` finite components. Centroids start as the kept vectors with the
    lowest sha256 of "seed:vec_id" (of equal ids the one with the lesser components goes first); with
    fewer than ``k`` kept vectors that have an id, there are so many centroids. Rows of equal vec_id
    are vectors of their own; one without vec_id is assigned like any other, but starts no centroid.
    Ties go to the smaller centroid. Without a vector, or without any that has an id, there are no
    rows. Other columns are ignored. Of the written matrices only the last stays.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, dimensions, scale)
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    matrix, path = stored_at(_updated(whole, centroids, None), "matrix")
    for _ in range(rounds):
        after = _moved(matrix, centroids)
        if (after == centroids).all():
            break
        newer, newer_path = stored_at(_updated(matrix, after, after - centroids), "matrix")
        remove(spark, path)
        matrix, path, centroids = newer, newer_path, after
    return matrix.select("vec_id", "cluster", "distance"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with the distances summed over its cluster and over all, and its centroid's digest.

    The sums are exact, and an error if they don't fit a long. One row per centroid goes to the driver
    and back.
    """
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: int(r.own) for r in assigned.groupBy("cluster").agg(total.alias("own")).collect()}
    whole = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(j, own, whole, digests[j]) for j, own in sums.items()]
    facts = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
