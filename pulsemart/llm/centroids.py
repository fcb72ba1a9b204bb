"""Integer k-means over vectors whose dot products with the centroids are kept and corrected.

Every vector's row carries its exact integer dot product with each centroid. When a centroid
moves, only the components that changed are multiplied, and what they add goes on top of the dot
product on file; the distance to centroid c is then |x|^2 - 2 x.c + |c|^2. All is in whole
numbers, so nothing drifts, however many rounds go by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import saved

#: Integer components beyond this could give a squared distance over 64 coordinates that no
#: LONG holds.
LARGEST = 1 << 27
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class Clusters:
    """Assigned vectors (id, x, dots, norm, cluster, distance) and the centroids they are held
    against, one row of whole numbers each."""

    vectors: DataFrame
    centroids: list[list[int]]


def whole_vectors(
    rows: DataFrame, id_column: str, vector: str, size: int, scale: int = 64
) -> DataFrame:
    """id and x, the components as floor(scale * component), of the vectors that can be used.

    Left out are vectors of another length, null ones, ones with a null or non-finite component,
    and ones with a component of more than 2^27 in amount, whose distances would not fit.
    """
    parts = F.col("parts")

    def whole(c: Column) -> Column:
        return F.floor(scale * c).cast("long")

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(F.floor(scale * c).cast("double")) <= LARGEST)

    return (
        rows.select(
            F.col(id_column).cast("long").alias("id"),
            F.col(vector).cast("array<double>").alias("parts"),
        )
        .where(F.size("parts") == size)
        .where(F.forall(parts, usable))
        .select("id", F.transform(parts, whole).alias("x"))
    )


def first_centroids(vectors: DataFrame, k: int, seed: str = "1") -> list[list[int]]:
    """The k vectors with the least SHA-256 of `seed:id`, in that order; fewer if there are fewer.

    Rows that share an id are told apart by their components; a row without id has no hash and
    is none of them.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    least = vectors.where("id IS NOT NULL").select(key.alias("key"), "x").orderBy("key", "x")
    return [list(r["x"]) for r in least.limit(k).collect()]


def moved(vectors: DataFrame, old: list[list[int]], new: list[list[int]]) -> DataFrame:
    """The vectors with dot products, nearest centroid and distance for the new centroids.

    A centroid's changed components alone are multiplied. `old` of zeros is the start, where a
    vector's dot products are zero as well.
    """
    changes = []
    for was, now in zip(old, new, strict=True):
        step = np.array(now, np.int64) - np.array(was, np.int64)
        at = np.flatnonzero(step)
        changes.append((at, step[at]))
    squares = np.array([sum(c * c for c in centroid) for centroid in new], np.int64)
    k, size = len(new), len(new[0])

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy().reshape(n, size)
            dots = batch.column("dots").flatten().to_numpy().reshape(n, k).copy()
            for c, (at, step) in enumerate(changes):
                if len(at):
                    dots[:, c] += x[:, at] @ step
            norm = batch.column("norm").to_numpy()
            distances = norm[:, None] - 2 * dots + squares[None, :]
            nearest = distances.argmin(axis=1)  # the first of equals
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("x"),
                    pa.FixedSizeListArray.from_arrays(dots.ravel(), k).cast(pa.list_(pa.int64())),
                    batch.column("norm"),
                    pa.array(nearest.astype(np.int32)),
                    pa.array(distances[np.arange(n), nearest]),
                ],
                ["id", "x", "dots", "norm", "cluster", "distance"],
            )

    return vectors.select("id", "x", "dots", "norm").mapInArrow(
        correct,
        "id long, x array<long>, dots array<long>, norm long, cluster int, distance long",
    )


def means(vectors: DataFrame, old: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of each cluster's mean; a cluster without vectors keeps its centroid.

    Sums are combined on the map side: one row per cluster and task is shuffled.
    """
    size = len(old[0])
    sums = vectors.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.get("x", j)).alias(f"s{j}") for j in range(size))
    )
    new = [list(c) for c in old]
    for row in sums.collect():  # a row per cluster
        new[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(size)]
    return new


def cluster(vectors: DataFrame, k: int, rounds: int, seed: str = "1") -> Clusters | None:
    """k-means over (id, x) rows: `rounds` times assign and move, then assign once more.

    Ties go to the centroid of the smaller number. The state is a table in the shared folder
    after every round, so a lost executor costs one round's part of its rows at most. Without
    a vector that has an id there are no centroids: None.
    """
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return None
    square = F.aggregate("x", F.lit(0).cast("long"), lambda s, c: s + c * c)
    zeros = F.array_repeat(F.lit(0).cast("long"), len(centroids))
    state = vectors.select("id", "x", zeros.alias("dots"), square.alias("norm"))
    old = [[0] * len(c) for c in centroids]
    for _ in range(rounds):
        state = saved(moved(state, old, centroids), "centroids")
        old, centroids = centroids, means(state, centroids)
    return Clusters(saved(moved(state, old, centroids), "centroids"), centroids)


def report(found: Clusters) -> DataFrame:
    """Per vector its cluster, squared distance, the distances summed over its cluster and over
    all (null where they pass a LONG), and the SHA-256 of its centroid's components."""
    sums = {
        r["cluster"]: int(r["inertia"])
        for r in found.vectors.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
        .collect()
    }
    digests = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids
    ]

    def long(value: int) -> Column:
        return F.lit(value if value <= LONG_MAX else None).cast("long")

    per = F.array(*(long(sums.get(c, 0)) for c in range(len(digests))))
    return found.vectors.select(
        F.col("id"),
        F.col("cluster"),
        F.col("distance"),
        F.get(per, F.col("cluster")).alias("cluster_inertia"),
        long(sum(sums.values())).alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )


def assign(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    k: int = 16,
    rounds: int = 3,
) -> DataFrame:
    """The report over a table of vectors: `id_column`, cluster, distance, cluster_inertia,
    inertia, centroid_sha256. Other columns are not read, so their names may clash with these.

    A row without id is assigned but never a first centroid; repeated rows each get a row; an
    empty table, or one without a usable vector that has an id, gives no rows.
    """
    found = cluster(whole_vectors(rows, id_column, vector, size), k, rounds)
    if found is None:
        spark = rows.sparkSession
        return spark.createDataFrame(
            [],
            f"`{id_column}` long, cluster int, distance long, cluster_inertia long, "
            "inertia long, centroid_sha256 string",
        )
    return report(found).withColumnRenamed("id", id_column)
