"""Corpus-wide counts of 64-bit hashes, asked for and told block by block.

A block of rows asks once for each distinct hash it has, packed by bucket of hashes; the bucket
adds up and sends the totals back in the same order. A frequent hash thus makes one entry per
block, wherever it occurs, and no hash fills a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import runs


def by_bucket(
    hashes: np.ndarray, n_buckets: int, weights: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Buckets that have any with their distinct hashes in order and the counts (or sums of
    weights) of these."""
    if weights is None:
        distinct, counts = np.unique(hashes, return_counts=True)
    else:
        distinct, where = np.unique(hashes, return_inverse=True)
        counts = np.bincount(where, weights, len(distinct))
    bucket = (distinct >> np.uint64(32)) % np.uint64(n_buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[b] : edges[b + 1]]
        yield b, distinct[own], counts[own]


def packed_hashes(hashes: np.ndarray) -> bytes:
    """Ascending hashes as steps, byte by byte across them: the high bytes are zeros and compress."""
    steps = np.diff(hashes, prepend=np.uint64(0)).astype("<u8")
    return steps.view("u1").reshape(-1, 8).T.tobytes()


def unpacked_hashes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, "u1").reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts byte by byte across them, in as many bytes as the largest one needs."""
    width = max(1, -(-int(counts.max()).bit_length() // 8))
    return bytes([width]) + counts.astype("<u8").view("u1").reshape(-1, 8).T[:width].tobytes()


def unpacked_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, "u1", offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), "u1")
    out[:, : data[0]] = planes.T
    return out.view("<i8").ravel()


def corpus_counts(
    blocks: DataFrame,
    hashes_of: Callable[[bytes, dict], Iterable[tuple]],
    n_buckets: int,
    told_before: DataFrame | None = None,
) -> DataFrame:
    """block, kind, bucket, counts: totals over all blocks, in the order of `by_bucket`.

    `blocks` has block and data; `hashes_of(data, told)` gives kind and hashes, for each kind that
    is counted by itself, and perhaps what each hash adds to its total. `told` is what the block
    knows from `told_before`, an earlier answer, by kind and bucket.
    """
    again = told_before is not None

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, dict]]:
        if again:
            for group in runs(batches, ["block"]):
                yield group["block"][0].as_py(), group["data"][0].as_py(), told_by_bucket(group)
            return
        for batch in batches:
            for block, data in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                yield block, data, {}

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        for block, data, told in known(batches):
            for kind, hashes, *weights in hashes_of(data, told):
                rows = [
                    (block, kind, b, packed_hashes(own), packed_counts(counts))
                    for b, own, counts in by_bucket(hashes, n_buckets, *weights)
                ]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        ["block", "kind", "bucket", "hashes", "counts"],
                    )

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["kind", "bucket"]):
            own = [unpacked_hashes(x) for x in group["hashes"].to_pylist()]
            counts = np.concatenate([unpacked_counts(x) for x in group["counts"].to_pylist()])
            _, where = np.unique(np.concatenate(own), return_inverse=True)
            total = np.bincount(where, counts).astype("<i8")[where]
            ends = np.cumsum([len(x) for x in own])[:-1]
            packed = [packed_counts(t) for t in np.split(total, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(group[c].combine_chunks() for c in ("block", "kind", "bucket")),
                    pa.array(packed, pa.binary()),
                ],
                ["block", "kind", "bucket", "counts"],
            )

    rows = with_counts(blocks, told_before) if again else blocks
    return (
        rows.mapInArrow(asked, "block long, kind int, bucket int, hashes binary, counts binary")
        .repartition("kind", "bucket")
        .sortWithinPartitions("kind", "bucket", "block")
        .mapInArrow(told, "block long, kind int, bucket int, counts binary")
    )


def with_counts(blocks: DataFrame, told: DataFrame) -> DataFrame:
    """Rows of each block and of what it was told, together and in order, the data first."""
    rows = blocks.select(
        "block",
        F.lit(-1).alias("kind"),
        F.lit(-1).alias("bucket"),
        F.lit(None).cast("binary").alias("counts"),
        "data",
    ).unionByName(told.withColumn("data", F.lit(None).cast("binary")))
    return rows.repartition("block").sortWithinPartitions("block", "kind", "bucket")


def told_by_bucket(group: pa.Table) -> dict[tuple[int, int], bytes]:
    """What a block was told, by kind and bucket."""
    columns = (group[c].to_pylist()[1:] for c in ("kind", "bucket", "counts"))
    return {(kind, bucket): counts for kind, bucket, counts in zip(*columns, strict=True)}


def totals_told(
    distinct: np.ndarray, told: dict[tuple[int, int], bytes], kind: int, n_buckets: int
) -> np.ndarray:
    """The total of each of some distinct, ascending hashes."""
    total = np.zeros(len(distinct), np.int64)
    for b, own, _ in by_bucket(distinct, n_buckets):
        total[np.searchsorted(distinct, own)] = unpacked_counts(told[kind, b])
    return total


def counts_told(
    hashes: np.ndarray, told: dict[tuple[int, int], bytes], kind: int, n_buckets: int
) -> np.ndarray:
    """The total of each hash."""
    distinct, local = np.unique(hashes, return_inverse=True)
    return totals_told(distinct, told, kind, n_buckets)[local]
