"""Reading the given tables, side tables in the shared folder, and words as hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pulsemart
from pulsemart.session import scratch_path, scratch_table

# Tasks get the functions they run with the job, so the package need not be on every machine.
cloudpickle.register_pickle_by_value(pulsemart)

# White space that separates words, as in the contracts: blank and the controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting: a query's shuffle files go when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that travel to a worker at a time; both sides hold that many.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Queries that run inside have this setting."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files at their end, not when the driver
    happens to collect its garbage."""
    with setting(spark, FREE_SHUFFLES, "true"):
        yield


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that later steps start from files.

    The step's shuffle files are of no use once it stands as a table, so they go.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_by(df: DataFrame, key: str, label: str) -> tuple[DataFrame, str]:
    """As `saved`, in as many buckets of the key as a shuffle has partitions: where rows meet others
    by this key, or their own copies, only the others move. `DROP TABLE` removes it, by the name
    that comes with it."""
    spark = df.sparkSession
    name = scratch_table(spark, label)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_freed(spark):
        df.write.format("parquet").bucketBy(n_buckets, key).saveAsTable(name)
    return spark.table(name), name


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class WordHashes(dict):
    """64-bit hash by word, remembered for up to `most` words at a time."""

    def __init__(self, most: int = 400_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection), so that any of them can be used."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words; of all of them if there are fewer, but any."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    count = len(hashes) - n + 1
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count] + np.uint64(i + 1))
    return out


def new_name(taken: Iterable[str], wish: str) -> str:
    """A column name that is not taken."""
    names = {t.lower() for t in taken}
    while wish.lower() in names:
        wish = f"_{wish}"
    return wish


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys, one group after the other, from rows sorted by integer keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        if held:
            change[0] = any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys)
        at = 0
        for border in np.flatnonzero(change).tolist():
            if border > at:
                held.append(batch.slice(at, border - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], border
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def release(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches as they come; memory that Arrow keeps for later goes back when they end, as
    worker processes outlive their tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()


def fingerprint(df: DataFrame) -> tuple:
    """Number of rows and a sum over them that does not depend on their order."""
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64(*df.columns))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node of an undirected graph of LONG columns a, b; root is the least.

    Alternates the large and the small star until nothing changes: each round hangs neighbours
    on the least node known, so stars form after a few rounds even in long chains.
    """
    edges = saved(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (now := fingerprint(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m")
        )
        large = (
            both.join(least, F.col("a") == F.col("n"))
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = saved(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        hung = large.join(least, F.col("a") == F.col("n"))
        edges = saved(
            hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b")
            .union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
    roots = edges.select(F.col("b").alias("a")).distinct()
    return edges.union(roots.select("a", F.col("a").alias("b"))).toDF("node", "root")
