"""Near duplicates by n-gram Jaccard similarity, found with chosen paths.

A text is the set of its five-word shingles; equal sets become one. Sets are embedded by min-hash
and recursively split: at each node of a random tree a set goes to the children of the tokens (a
coordinate and its min-hash) that the node samples, on average 1 / similarity of them. Small
buckets are compared outright; large ones split again. Runs repeat until the recall aimed at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import (
    WordHashes,
    components,
    mixed,
    runs,
    saved,
    text_of,
    windows,
)
from pulsemart.operators.sizes import broadcast_if_small

WORDS = 5
SIMILARITY = 0.8
COORDINATES = 64
#: Agreeing coordinates below which a pair is no candidate. A pair of similarity 0.8 falls below
#: with a chance of about 5e-6.
AGREE = 36
#: A bucket of more sets is split further, down to DEPTH.
BUCKET = 128
DEPTH = 5
RECALL = 0.999
#: Sets of one bucket or component that a task compares with one another; larger ones are cut into
#: blocks and compared block by block.
BLOCK = 1024


def run_count(recall: float, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair of this similarity has met in a bucket with this probability.

    A node samples one token, and a second one often enough for 1 / similarity on average. A
    pair is lost at a node if every sampled token tells it apart, or loses it further down.
    """
    second = 1 / similarity - 1
    lost = 0.0
    for _ in range(depth):
        miss = 1 - similarity + similarity * lost
        lost = (1 - second) * miss + second * miss * miss
    return math.ceil(math.log(1 - recall) / math.log(lost))


def shingles_of(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word runs; of the whole text if it is shorter."""
    return np.unique(windows(hashes.of(text.lower().split()), WORDS))


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


def min_hashes(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    out = np.empty(len(seeds), np.uint64)
    for i, seed in enumerate(seeds):
        out[i] = (shingles * seed).min() >> np.uint64(32)
    return out.astype(np.uint32).view(np.int32)


def coordinates() -> np.ndarray:
    """Odd factors, one per coordinate, fixed."""
    return mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, set_key, sig of every row; key and sig are null for a text without words."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seeds = WordHashes(), coordinates()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys, sigs = [], []
                for text in part.column(2).to_pylist():
                    own = shingles_of(text, hashes)
                    keys.append(set_key(own) if len(own) else None)
                    sigs.append(min_hashes(mixed(own), seeds) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(keys, pa.binary()),
                        pa.array(sigs, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "text_hash", "set_key", "sig"],
                )

    return with_hash(docs).mapInArrow(
        signed, "doc_id long, text_hash long, set_key binary, sig array<int>"
    )


def with_hash(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text: rows that share a doc_id, or have none, are found by both."""
    text = text_of("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def buckets(sets: DataFrame, recall: float) -> DataFrame:
    """bucket, s, n: sets that share a final bucket, n sets in all, at least two."""
    n_runs = run_count(recall)

    def children(nodes: DataFrame) -> DataFrame:
        token = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(COORDINATES)).cast("int")
        other = F.pmod(F.xxhash64("path", F.lit(2)), F.lit(COORDINATES)).cast("int")
        draw = F.pmod(F.xxhash64("path", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
        second = (draw < 1 / SIMILARITY - 1) & (other != token)
        tokens = F.when(second, F.array(token, other)).otherwise(F.array(token))
        return nodes.withColumn("token", F.explode(tokens)).select(
            "s", F.xxhash64("path", "token", F.get("sig", F.col("token"))).alias("path")
        )

    nodes = sets.select("s", "sig", F.explode(F.sequence(F.lit(1), F.lit(n_runs))).alias("run"))
    nodes = nodes.select("s", "sig", F.xxhash64("run").alias("path"))
    found = None
    for depth in range(1, DEPTH + 1):
        level = saved(children(nodes), "paths")
        sizes = level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        shared = saved(
            level.join(sizes.withColumnRenamed("path", "p"), F.col("path") == F.col("p")).drop("p"),
            "paths",
        )
        final = shared if depth == DEPTH else shared.where(F.col("n") <= BUCKET)
        final = final.select(F.col("path").alias("bucket"), "s", "n")
        found = final if found is None else found.union(final)
        if depth < DEPTH:
            deeper = shared.where(F.col("n") > BUCKET).select("s", "path").distinct()
            if deeper.isEmpty():
                break
            nodes = deeper.join(sets.select("s", "sig"), "s")
    return found.distinct()


def in_blocks(rows: DataFrame, group: str) -> DataFrame:
    """Rows of groups of n dealt to blocks: every two rows of a group meet in a block.

    With k blocks, a row goes to the k pairs of blocks that its own is in; left tells whether
    its own block is the first of the pair. The copies grow as n / BLOCK, as comparing all must.
    """
    k = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("s", F.lit(7)), k).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("left", F.col("own") == F.col("i"))
        .drop("own", "other", "n")
        .repartition(group, "i", "j")
        .sortWithinPartitions(group, "i", "j", "s")
    )


def local_roots(close: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id of each row's component under a symmetric boolean matrix; ids are ascending."""
    label = np.arange(len(ids))
    while True:
        best = np.where(close, label[None, :], len(ids)).min(1)
        best = np.minimum(best, label)
        best = best[best]
        if (best == label).all():
            return ids[label]
        label = best


def candidates(sets: DataFrame, found: DataFrame) -> DataFrame:
    """Edges a, b between candidates, few per set: a set and the least one of its kind."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in runs(batches, ["bucket", "i", "j"]):
            ids = group["s"].to_numpy()
            sig = group["sig"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            if len(ids) == 2:
                if (sig[0] == sig[1]).sum() >= AGREE:
                    a.append(ids[1:])
                    b.append(ids[:1])
            else:
                close = np.zeros((len(ids), len(ids)), bool)
                for at in range(0, len(ids), 64):
                    close[at : at + 64] = (sig[at : at + 64, None, :] == sig[None]).sum(2) >= AGREE
                root = local_roots(close, ids)
                own = root != ids
                a.append(ids[own])
                b.append(root[own])
            if len(a) > 20_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
                )
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
            )

    members = found.join(sets.select("s", "sig"), "s")
    return in_blocks(members, "bucket").select("bucket", "i", "j", "s", "sig").mapInArrow(
        edges, "a long, b long"
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 blocks of columns."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    out = np.zeros((n, n), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        part = np.zeros((n, int(column[hi - 1]) - start + 1), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        out += part @ part.T
    return out.astype(np.int64)


def verified(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Exact links within candidate components: s, root, links.

    `members` has s, set_key, found (doc_id, text_hash), copies, component, n. Every pair of a component is
    compared once. `links` counts the documents linked to (copies counted), `root` is a linked
    set that ties the class together.
    """

    def with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rest = [part.column(c) for c in ("s", "copies", "component", "n")]
                own = [shingles_of(t, hashes) for t in part.column("text").to_pylist()]
                same = [
                    set_key(x) == k
                    for x, k in zip(own, part.column("set_key").to_pylist(), strict=True)
                ]
                found = pa.RecordBatch.from_arrays(
                    [*rest, pa.array([x.astype("<u8").tobytes() for x in own], pa.binary())],
                    ["s", "copies", "component", "n", "shingles"],
                )
                yield found.filter(pa.array(same))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["component", "i", "j"]):
            ids, first = np.unique(group["s"].to_numpy(), return_index=True)  # repeated rows once
            group = group.take(first)
            sets = [np.frombuffer(x, "<u8") for x in group["shingles"].to_pylist()]
            copies, left = group["copies"].to_numpy(), group["left"].to_numpy()
            size = np.array([len(x) for x in sets])
            both = overlaps(sets)
            close = both >= SIMILARITY * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(close, False)
            if group["i"][0] != group["j"][0]:
                close &= left[:, None] != left[None, :]
            n = close @ copies
            own = n > 0
            root = local_roots(close, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[own]), pa.array(root[own]), pa.array(n[own].astype(np.int64))],
                ["s", "root", "links"],
            )

    wanted = members.select(
        "s",
        "set_key",
        "copies",
        "component",
        "n",
        F.col("found.doc_id").alias("__doc"),
        F.col("found.text_hash").alias("__hash"),
    )
    shingled = (
        with_hash(docs)
        .join(
            wanted,
            F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")),
        )
        .select("s", "copies", "component", "n", "set_key", "text")
        .mapInArrow(
            with_shingles, "s long, copies long, component long, n long, shingles binary"
        )
    )
    return in_blocks(shingled, "component").mapInArrow(links, "s long, root long, links long")


def join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies, one row per row of documents.

    `class_id` is the least doc_id of the documents that links of similarity 0.8 or more connect.
    `n_links` counts the other documents with such a link, copies included; a third row with
    the same words is one more. `n_copies` counts rows with the same shingles, itself included.
    Words are split at white space in lower case. A text of fewer than five words is one
    shingle; one without words (or null) has no links and its own doc_id as class. Rows without
    a doc_id take part; their class may be null. Other columns are ignored.
    """
    signed = saved(signatures(docs), "signatures")
    sets = saved(
        signed.where(F.col("set_key").isNotNull())
        .groupBy("set_key")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value(F.struct("doc_id", "text_hash")).alias("found"),
            F.count("*").alias("copies"),
            F.any_value("sig").alias("sig"),
        )
        .withColumn("s", F.monotonically_increasing_id()),
        "sets",
    )
    grouped = saved(components(candidates(sets, buckets(sets, recall))), "candidates")
    sizes = grouped.groupBy("root").agg(F.count("*").alias("n"))
    members = (
        grouped.join(sizes, "root")
        .select(F.col("node").alias("s"), F.col("root").alias("component"), "n")
        .join(sets.drop("sig"), "s")
    )
    linked = saved(verified(docs, members), "links")
    classes = components(linked.select(F.col("s").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("s").agg(F.sum("links").alias("links"))
    of_set = saved(
        sets.drop("sig")
        .join(classes.withColumnRenamed("node", "s"), "s", "left")
        .join(counts, "s", "left")
        .withColumn("class", F.coalesce("root", "s"))
        .select("s", "set_key", "doc_id", "copies", "class", F.coalesce("links", F.lit(0)).alias("links")),
        "classes",
    )
    names = of_set.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    of_set = of_set.join(names, "class").select(
        F.col("set_key").alias("__key"), "class_id", "links", "copies"
    )
    empty = F.col("set_key").isNull()
    return signed.select("doc_id", "set_key").join(
        of_set, F.col("set_key") == F.col("__key"), "left"
    ).select(
        "doc_id",
        F.when(empty, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, 0).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(empty, 1).otherwise(F.col("copies")).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Documents less all but one of each class; the least doc_id stays.

    A doc_id names a document: where several rows have one, one row per doc_id and text stays.
    Rows without a doc_id cannot be named and stay.
    """
    found = saved(join(docs, recall), "near-duplicates")
    gone = found.where(F.col("class_id") != F.col("doc_id")).select("doc_id").distinct()
    gone = broadcast_if_small(saved(gone, "gone"))
    repeated = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    repeated = saved(repeated.select("doc_id"), "repeated")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if repeated.isEmpty():
        return left
    single = left.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    double = left.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return single.unionByName(double.dropDuplicates(["doc_id", "text"]))
