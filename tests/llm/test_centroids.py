import hashlib
import math
import random

import pytest

from trolley.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, x string, dots int"


def plain(rows, k, rounds, width):
    """Every distance anew in every round, with Python's integers."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v, *_ in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    start = sorted((r for r in kept if r[0] is not None), key=key)[:k]
    places = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(places))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(places)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if members:
                places[j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept] if places else [], places


def vectors(seed, n, width):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(width)]) for i in range(n)]
    rows += [(i, rows[0][1]) for i in range(n, n + 40)]  # many equal vectors
    rows += [(5, rows[7][1]), (None, rows[3][1]), (None, rows[3][1]), (5, rows[7][1])]
    rows += [(900, None), (901, []), (902, [1.0] * (width - 1)), (903, [None] * width), (904, [math.nan] * width), (905, [math.inf] * width)]
    return [(i, v, "c", "x", 1) for i, v in rows]


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("seed, n, k", [(1, 150, 40), (2, 60, 7), (3, 3, 40)])
def test_against_plain_rounds(spark, seed, n, k):
    rows = vectors(seed, n, 6)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got, places = centroids.clustered(docs, k=k, dimensions=6)
    expected, last = plain(rows, k, centroids.ROUNDS, 6)
    assert sort(tuple(r) for r in got.collect()) == sort(expected)
    assert places.tolist() == last
    facts = centroids.with_inertia(got, places).collect()
    for r in facts:
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in expected)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, last[r.cluster])).encode()).hexdigest()


def test_no_vectors(spark):
    none = spark.createDataFrame([(None, [1.0] * 64, None, None, None), (3, [1.0], None, None, None)], SCHEMA)
    assert centroids.with_inertia(*centroids.clustered(none.limit(0))).collect() == []
    assert centroids.with_inertia(*centroids.clustered(none)).collect() == []


def test_components_too_large_are_refused(spark):
    big = spark.createDataFrame([(1, [1e300] * 64, None, None, None)], SCHEMA)
    with pytest.raises(Exception, match="not within"):
        centroids.clustered(big)
