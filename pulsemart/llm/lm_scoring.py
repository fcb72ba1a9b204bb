"""Stupid-backoff scores of documents under the n-grams of the whole corpus.

The count tables are partitioned by n-gram hash and joined to the documents' n-grams. Rows are
packed: a row holds all n-grams that a block of documents has in one bucket of hashes, so each
n-gram travels once per block, with its count, and its total comes back. Counts are asked for in
steps, words and pairs first. A longer n-gram that another document has too has all its parts there,
so only those whose every part of the length asked for last occurs in another document are asked
for; of the others no other document has any.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import WordHashes, mixed, release, runs, saved, text_of
from pulsemart.llm.counts import corpus_counts, told_by_bucket, totals_told, with_counts

ORDER = 5
BACKOFF = 0.4
BLOCK_WORDS = 2_000_000
BUCKET_GRAMS = 2_000_000

PACKED = "block long, n_words long, data binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Documents packed in blocks of about BLOCK_WORDS words: block, n_words, data."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = WordHashes(), TaskContext.get().partitionId() << 32
        ids: list = []
        words: list[np.ndarray] = []
        held = 0

        def finished() -> pa.RecordBatch:
            vocabulary, local, seen = np.unique(
                np.concatenate(words), return_inverse=True, return_counts=True
            )
            # Frequent words get the small numbers, and numbers are laid down byte by byte.
            often = np.argsort(-seen, kind="stable")
            place = np.empty(len(often), "<u4")
            place[often] = np.arange(len(often), dtype="<u4")
            parts = [
                np.array([len(ids), len(vocabulary), held], "<i8"),
                np.array([d is not None for d in ids], "<i8"),
                np.array([d or 0 for d in ids], "<i8"),
                np.array([len(w) for w in words], "<i8"),
                vocabulary[often].astype("<u8"),
                place[local].view("u1").reshape(-1, 4).T,
            ]
            data = zstandard.ZstdCompressor(1).compress(b"".join(p.tobytes() for p in parts))
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int64()),
                    "n_words": pa.array([held], pa.int64()),
                    "data": pa.array([data], pa.binary()),
                }
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc, text in zip(*(part.column(i).to_pylist() for i in (0, 1)), strict=True):
                    own = hashes.of(text.lower().split())
                    ids.append(doc)
                    words.append(own)
                    held += len(own)
                    if held >= BLOCK_WORDS:
                        yield finished()
                        ids, words, held, number = [], [], 0, number + 1
        if ids:
            yield finished()

    rows = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    return saved(rows.mapInArrow(packed, PACKED), "lm-blocks")


class Block:
    """A block unpacked: documents, their sizes, and the word hash at each place."""

    def __init__(self, data: bytes) -> None:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, v, words = np.frombuffer(raw, "<i8", 3).tolist()
        there, ids, self.sizes = np.frombuffer(raw, "<i8", 3 * n, 24).reshape(3, n)
        self.ids = [i if ok else None for ok, i in zip(there.tolist(), ids.tolist(), strict=True)]
        vocabulary = np.frombuffer(raw, "<u8", v, 24 * (n + 1))
        planes = np.frombuffer(raw, "u1", 4 * words, 24 * (n + 1) + 8 * v).reshape(4, words)
        self.words = vocabulary[np.ascontiguousarray(planes.T).view("<u4").ravel()]
        self.doc = np.repeat(np.arange(n), self.sizes)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each n-gram that lies within a document, and the place of its last word."""
        count = len(self.words) - order + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.zeros(count, np.uint64)
        for i in range(order):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + self.words[i : i + count] + np.uint64(i + 1))
        inside = self.doc[:count] == self.doc[order - 1 :]
        return out[inside], np.flatnonzero(inside) + order - 1


def own_counts(block: Block, local: np.ndarray, last: np.ndarray) -> np.ndarray:
    """How often its document has each n-gram, given by a number within the block."""
    key = block.doc[last] * (int(local.max(initial=0)) + 1) + local
    _, where, own = np.unique(key, return_inverse=True, return_counts=True)
    return own[where]


def both_counts(
    block: Block, grams: np.ndarray, last: np.ndarray, told: dict, size: int, n_buckets: int
) -> tuple[np.ndarray, np.ndarray]:
    """The corpus count of each n-gram, and how often its document has it."""
    distinct, local = np.unique(grams, return_inverse=True)
    total = totals_told(distinct, told, size - 1, n_buckets)
    return total[local], own_counts(block, local, last)


def steps(order: int) -> list[tuple[int, int]]:
    """First and last length of the n-grams asked for in each step: 1 and 2, 3, 4 and 5, and so on."""
    starts = [1, 3, *range(4, order + 1, 2)]
    ends = [2, 3, *range(5, order + 2, 2)]
    return [(a, min(b, order)) for a, b in zip(starts, ends, strict=True) if a <= order]


@dataclass
class Elsewhere:
    """Whether another document has the n-gram of `length` that ends at a place; 0: not known."""

    block: Block
    length: int = 0
    at: np.ndarray | None = None

    def asked_for(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams whose corpus count is asked for, and the places of their last words."""
        grams, last = self.block.grams(size)
        if self.length:
            may = np.ones(len(last), bool)
            for back in range(size - self.length + 1):
                may &= self.at[last - back]
            grams, last = grams[may], last[may]
        return grams, last

    def learn(self, size: int, last: np.ndarray, total: np.ndarray, own: np.ndarray) -> None:
        self.length, self.at = size, np.zeros(len(self.block.words), bool)
        self.at[last] = total > own


def learnt(block: Block, told: dict, lengths: list[int], n_buckets: int) -> Elsewhere:
    """What the answers of earlier steps, for the last length of each, tell about longer n-grams."""
    others = Elsewhere(block)
    for size in lengths:
        grams, last = others.asked_for(size)
        others.learn(size, last, *both_counts(block, grams, last, told, size, n_buckets))
    return others


def known_counts(
    block: Block, told: dict, order: int, n_buckets: int, leave_out: bool
) -> list[np.ndarray]:
    """By length, the count of the n-gram that ends at each place; 0 where there is none."""
    known, others = [], Elsewhere(block)
    for first, top in steps(order):
        for size in range(first, top + 1):
            grams, last = others.asked_for(size)
            total, own = both_counts(block, grams, last, told, size, n_buckets)
            at = np.zeros(len(block.words))
            if not leave_out and others.length:  # what is not asked for is in this document alone
                every, ends = block.grams(size)
                at[ends] = own_counts(block, np.unique(every, return_inverse=True)[1], ends)
            at[last] = total - own if leave_out else total
            known.append(at)
        others.learn(top, last, total, own)
    return known


def block_scores(
    block: Block, known: list[np.ndarray], corpus_words: int, leave_out: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log scores and number of words scored by a shorter n-gram, by document."""
    n, places = len(block.ids), len(block.words)
    total = np.full(n, float(corpus_words))
    if leave_out:
        total = total - block.sizes
    top = len(known)
    # How many words of its document stand before a word bounds the order that can score it.
    begin = np.cumsum(block.sizes) - block.sizes
    before = np.arange(places) - begin[block.doc]
    possible = np.minimum(before + 1, top)
    # With nothing known about a word it scores as if seen once in a corpus of one word more.
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.log(np.where(known[0] > 0, known[0], 1.0) / (total[block.doc] + (known[0] <= 0)))
        score = score + np.where(known[0] > 0, 0.0, np.log(BACKOFF))
        level = np.ones(places, np.int64)
        for size in range(2, top + 1):
            context = np.zeros(places)
            context[1:] = known[size - 2][:-1]
            seen = (known[size - 1] > 0) & (possible >= size)
            direct = np.log(known[size - 1] / np.where(context > 0, context, 1.0))
            score = np.where(seen, direct, np.where(possible >= size, score + np.log(BACKOFF), score))
            level = np.where(seen, size, level)
    short = (level < possible) | (known[0] <= 0)
    return np.bincount(block.doc, score, n), np.bincount(block.doc, short, n).astype(np.int64)


def score(docs: DataFrame, order: int = ORDER, leave_out: bool = True) -> DataFrame:
    """doc_id, n_words, n_backoff, log_score, mean_log_score, one row per row of documents.

    Words are split at white space in lower case. A word scores the relative frequency of the
    longest n-gram that the corpus has, times 0.4 for each step to a shorter one. With `leave_out` a
    document's own n-grams are not counted. A text without words (or null) sums to 0 and has a
    null mean. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    packed = blocks(docs)
    corpus_words = packed.agg(F.sum("n_words")).first()[0] or 0
    n_buckets = max(8, -(-corpus_words // BUCKET_GRAMS))
    rows = packed.select("block", "data")

    def step_counts(first: int, top: int, before: list[int], told: DataFrame | None) -> DataFrame:
        def hashes(data: bytes, told: dict) -> Iterator[tuple[int, np.ndarray]]:
            others = learnt(Block(data), told, before, n_buckets)
            for size in range(first, top + 1):
                yield size - 1, others.asked_for(size)[0]

        needed = None
        if told is not None:
            needed = told.where(F.col("kind").isin([size - 1 for size in before]))
        return saved(corpus_counts(rows, hashes, n_buckets, needed), "lm-counts")

    told, before = None, []
    for first, top in steps(order):
        found = step_counts(first, top, before, told)
        told = found if told is None else told.unionByName(found)
        before.append(top)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(release(batches), ["block"]):
            block, found = Block(group["data"][0].as_py()), told_by_bucket(group)
            known = known_counts(block, found, order, n_buckets, leave_out)
            sums, short = block_scores(block, known, corpus_words, leave_out)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = sums / block.sizes
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids, pa.int64()),
                    pa.array(block.sizes, pa.int64()),
                    pa.array(short, pa.int64()),
                    pa.array(sums, pa.float64()),
                    pa.array(mean, pa.float64(), mask=block.sizes == 0),
                ],
                ["doc_id", "n_words", "n_backoff", "log_score", "mean_log_score"],
            )

    return with_counts(rows, told).mapInArrow(
        scored,
        "doc_id long, n_words long, n_backoff long, log_score double, mean_log_score double",
    )
