import hashlib
import math
import random

import numpy as np
import pytest

from pulsemart.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, id string, cluster string, x int"


def plain(rows, size=64, k=16, rounds=3):
    """Distances taken in full from the definition, in Python's own integers."""
    kept = [
        (i, [math.floor(64 * c) for c in v])
        for i, v, *_ in rows
        if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]
    starts = sorted(
        (hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None
    )
    middle = [x for _, x in starts[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        own = [[] for _ in middle]
        for _, x in kept:
            own[nearest(x)[1]].append(x)
        middle = [
            [sum(c) // len(xs) for c in zip(*xs, strict=True)] if xs else old
            for xs, old in zip(own, middle, strict=True)
        ]
    out = [(i, *nearest(x)[::-1]) for i, x in kept]
    sums = [sum(d for _, c, d in out if c == n) for n in range(len(middle))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, c, d, sums[c], sum(sums), digests[c]) for i, c, d in out]


def vectors(n, spread, seed):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(64)], "a", "b", 1) for i in range(n)]


ODD = [
    (None, [0.5] * 64, None, None, None),
    (7, [1.0] * 63, None, None, None),
    (8, None, None, None, None),
    (9, [float("nan")] + [0.0] * 63, None, None, None),
    (10, [float("inf")] * 64, None, None, None),
    (11, [None] + [0.0] * 63, None, None, None),
    (12, [], None, None, None),
    (3, [0.25] * 64, None, None, None),
    (3, [0.25] * 64, None, None, None),
    (3, [-0.25] * 64, None, None, None),
    (-5, [-0.0] * 64, None, None, None),
    (13, [1e6] * 64, None, None, None),
]


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize(
    "rows",
    [
        vectors(300, 0.2, 1) + ODD,
        vectors(5, 1.0, 2),
        vectors(40, 0.01, 3) * 4,
        [(i, [0.5] * 64, None, None, None) for i in range(40)],
    ],
    ids=["mixed", "fewer than centroids", "repeated", "all alike"],
)
def test_same_as_full_distances(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert order(centroids.assign(df).collect()) == order(plain(rows))


def test_nothing_to_assign(spark):
    for rows in ([], ODD[1:3], ODD[:1]):
        found = centroids.assign(spark.createDataFrame(rows, SCHEMA))
        assert found.collect() == []
        assert found.columns == [
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
        ]


def test_components_whose_distances_do_not_fit_are_left_out(spark):
    rows = vectors(20, 1.0, 4) + [(99, [1e30] + [0.0] * 63, None, None, None)]
    found = centroids.assign(spark.createDataFrame(rows, SCHEMA))
    assert order(found.collect()) == order(plain(rows[:-1]))


def test_a_still_centroid_costs_no_products(spark):
    rows = spark.createDataFrame(vectors(30, 0.2, 5), SCHEMA)
    whole = centroids.whole_vectors(rows, "vec_id", "embedding", 64)
    found = centroids.cluster(whole, 4, 2)
    again = centroids.moved(found.vectors, found.centroids, found.centroids)
    assert order(again.drop("x", "dots").collect()) == order(found.vectors.drop("x", "dots").collect())
    x = np.array([r["x"] for r in found.vectors.collect()])
    dots = np.array([r["dots"] for r in found.vectors.collect()])
    assert (dots == x @ np.array(found.centroids).T).all()
