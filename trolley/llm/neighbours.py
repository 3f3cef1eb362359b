"""Approximate nearest neighbours: a forest of random-projection trees.

Each tree halves the space again and again along random directions; the halves' thresholds are
medians of a bounded sample. A query walks all trees through one priority queue, nearest side first,
and takes the leaves it meets. Candidates of those leaves are then ranked by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import stored

#: Vectors the thresholds are fitted on, at most (those with the smallest hash). All are indexed.
SAMPLE = 16_384
TREES, LEAF_ROWS = 12, 1_024
#: A query visits as many leaves as there are trees, and VISITED * (leaves of a tree) ** POWER more:
#: the growth at which the measured recall stays the same from 51,282 to 3.1 million vectors (README).
VISITED, POWER = 3.0, 0.75
#: Leaves of more vectors than this are cut into slices, each a group of its own.
SLICE_ROWS = 4 * LEAF_ROWS
#: Distances are worked out in blocks of so many vectors.
BLOCK = 2_048


@dataclass
class Forest:
    """``directions[t, d]`` is what tree t splits along at depth d, ``thresholds[t]`` where, by node
    (children of i: 2i + 1 and 2i + 2). All leaves lie at the same depth."""

    directions: np.ndarray
    thresholds: np.ndarray

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.empty((len(vectors), len(self.directions)), np.int64)
        for t, (directions, thresholds) in enumerate(zip(self.directions, self.thresholds, strict=True)):
            side = vectors @ directions.T
            node = np.zeros(len(vectors), np.int64)
            for d in range(self.depth):
                node = 2 * node + 1 + (side[:, d] > thresholds[node])
            out[:, t] = node - len(thresholds)
        return out

    def visits(self, vector: np.ndarray, leaves: int) -> list[tuple[int, int]]:
        """The (tree, leaf) that a query meets first, in all trees together."""
        side = self.directions @ vector
        queue = [(0.0, t, 0, 0) for t in range(len(self.directions))]
        found: list[tuple[int, int]] = []
        inner = self.thresholds.shape[1]
        while queue and len(found) < leaves:
            far, t, node, d = heapq.heappop(queue)
            while d < self.depth:
                margin = side[t, d] - self.thresholds[t, node]
                right = int(margin > 0)
                d += 1
                heapq.heappush(queue, (far + float(margin) ** 2, t, 2 * node + 2 - right, d))
                node = 2 * node + 1 + right
            found.append((t, node - inner))
        return found


def fit(sample: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 6) -> Forest:
    """Trees for ``rows`` vectors, with leaves of about ``leaf_rows``, as deep as the sample allows."""
    rnd = np.random.default_rng(seed)
    wanted = max(0, int(np.ceil(np.log2(max(1, rows) / leaf_rows))))
    depth = min(wanted, max(0, int(np.log2(max(1, len(sample))))))
    directions = rnd.standard_normal((trees, depth, sample.shape[1]))
    if depth:
        directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    thresholds = np.zeros((trees, (1 << depth) - 1))
    for t in range(trees):
        side = sample @ directions[t].T
        members = [np.arange(len(sample))]
        for node in range((1 << depth) - 1):
            d = (node + 1).bit_length() - 1
            own = members[node]
            if len(own):
                thresholds[t, node] = np.median(side[own, d])
            right = side[own, d] > thresholds[t, node]
            members += [own[~right], own[right]]
    return Forest(directions, thresholds)


def visits_for(forest: Forest) -> int:
    return len(forest.directions) + int(np.ceil(VISITED * (1 << forest.depth) ** POWER))


def valid(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a vec_id whose vector isn't NULL, empty, zero, or in part NULL or not finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0))


def commonest_length(rows: DataFrame, vector: str = "embedding") -> int:
    """The length that most vectors have (the smaller of two), 0 without vectors."""
    lengths = rows.groupBy(F.size(vector).alias("length")).count().orderBy(F.desc("count"), "length").first()
    return lengths["length"] if lengths else 0


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def crowded(rows: DataFrame, forest: Forest) -> dict[int, int]:
    """The number of slices of each leaf with more than SLICE_ROWS vectors, by tree << 32 | leaf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), BLOCK):
                own = forest.leaves_of(_matrix(whole.column(0).slice(a, BLOCK))) + (np.arange(len(forest.directions)) << 32)
                leaf, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(n)], ["leaf", "n"])

    sizes = rows.select("vector").mapInArrow(run, "leaf bigint, n bigint").groupBy("leaf").agg(F.sum("n").alias("n"))
    return {r["leaf"]: -(-r["n"] // SLICE_ROWS) for r in sizes.where(F.col("n") > SLICE_ROWS).collect()}


def _placed(rows: DataFrame, forest: Forest, leaves: int | None, slices: dict[int, int]) -> DataFrame:
    """(leaf, id, vector): each row in its leaf of every tree, or in the leaves a query visits. Of a
    leaf in ``slices`` a row is in one slice, by a hash of its id, and a query in all."""
    vector_type = rows.schema["vector"].dataType.simpleString()
    crowds = np.array(sorted(slices), np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), BLOCK):
                batch = whole.slice(a, BLOCK)
                matrix = _matrix(batch.column(1))
                if leaves is None:
                    own = forest.leaves_of(matrix) + (np.arange(len(forest.directions)) << 32)
                    row, leaf = np.repeat(np.arange(len(batch)), own.shape[1]), own.ravel()
                    salts = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                    for i in np.flatnonzero(np.isin(leaf, crowds)):
                        leaf[i] += salts[row[i]] % slices[int(leaf[i])] << 40
                else:
                    codes = [[(t << 32) + x for t, x in forest.visits(v, leaves)] for v in matrix]
                    met = [[c + (s << 40) for c in m for s in range(slices.get(c, 1))] for m in codes]
                    row, leaf = np.repeat(np.arange(len(batch)), [len(m) for m in met]), np.concatenate([*met, []]).astype(np.int64)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *taken.columns], ["leaf", "id", "vector"])

    return rows.select("id", "vector").mapInArrow(run, f"leaf bigint, id bigint, vector {vector_type}")


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision, added up component by component."""
    total = np.zeros((len(queries), len(vectors)))
    for j in range(queries.shape[1]):
        total += (queries[:, j, None] - vectors[None, :, j]) ** 2
    return np.sqrt(total)


def _leaf_ranking(k: int):
    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        ids, reps = queries.column("id").to_numpy(), members.column("id").to_numpy()
        out = []
        if len(ids) and len(reps):
            q, v = _matrix(queries.column("vector")), _matrix(members.column("vector"))
            for a in range(0, len(q), BLOCK // 16):
                best_id, best = np.empty((len(q[a : a + BLOCK // 16]), 0), np.int64), None
                for b in range(0, len(v), BLOCK):
                    d = distances(q[a : a + BLOCK // 16], v[b : b + BLOCK])
                    best = d if best is None else np.hstack([best, d])
                    best_id = np.hstack([best_id, np.broadcast_to(reps[b : b + BLOCK], d.shape)])
                    order = np.lexsort((best_id, best))[:, : k + 1]
                    best, best_id = np.take_along_axis(best, order, 1), np.take_along_axis(best_id, order, 1)
                out.append((np.repeat(ids[a : a + BLOCK // 16], best.shape[1]), best_id.ravel(), best.ravel()))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, int), np.empty(0, int), np.empty(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "rep": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of ``queries`` among the
    ``vectors`` with another vec_id; ties go to the smaller vec_id.

    Both have vec_id and embedding; other columns are ignored. Vectors that ``valid`` leaves out, and
    those of another length than most of ``vectors`` have, take no part on either side. Equal vectors
    are indexed once, with their k + 1 smallest ids, of which no more can be asked for, and equal query
    vectors are searched once. Repeated rows count once. Leaves are matched by a shuffle on
    (tree, leaf, slice); per slice and query at most k + 1 candidates leave the task.
    """
    length = commonest_length(valid(vectors))
    rows, asked = (
        valid(side).where(F.size("embedding") == length).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
        for side in (vectors, queries)
    )
    asked = stored(asked.select(F.col("vec_id").alias("asked"), "vector").dropDuplicates(), "queries")
    searched = asked.groupBy("vector").agg(F.min("asked").alias("id"))
    first = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1)
    classes = few.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = stored(classes.select(F.get("ids", F.lit(0)).alias("id"), "ids", "vector"), "vectors")
    some = classes.orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).select("vector").toArrow()
    if not len(some):
        return classes.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    forest = fit(_matrix(some.column(0)), classes.count(), trees, leaf_rows)
    slices = crowded(classes, forest) if forest.depth else {}
    index = _placed(classes, forest, None, slices)
    wanted = _placed(searched, forest, visits_for(forest), slices)
    found = wanted.groupBy("leaf").cogroup(index.groupBy("leaf")).applyInArrow(_leaf_ranking(k), "query_id bigint, rep bigint, score double")
    found = found.groupBy("query_id", "rep").agg(F.min("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy("score", "rep")
    near = found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k + 1)
    named = near.join(classes.select(F.col("id").alias("rep"), "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id"))
    named = named.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    # Of the k + 1 nearest of a vector, each of its ids leaves out itself.
    nearby = Window.partitionBy("query_id").orderBy("score", "vec_id")
    named = named.withColumn("place", F.row_number().over(nearby)).where(F.col("place") <= k + 1).drop("place")
    own = asked.join(searched, "vector").select("asked", F.col("id").alias("query_id"))
    named = own.join(named, "query_id").where("vec_id <> asked").select(F.col("asked").alias("query_id"), "vec_id", "score")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return named.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
