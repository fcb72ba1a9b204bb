"""Token files compressed with a Re-Pair grammar, readable document by document."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import saved, text_of
from pulsemart.llm.tokens import BYTE_PIECES, Encoder

#: Distinct pieces that a worker remembers, some 200 MB of them.
PIECES = 1_000_000
MAGIC = b"RPG1"
HEAD = "<4sIIQQ"  # magic, first nonterminal, rules, documents, symbols
SYMBOLS = 1 << 16  # symbols are stored in 16 bits where the vocabulary leaves room for rules


def frequent_pairs(keys: np.ndarray, least: int, most: int) -> np.ndarray:
    """The most frequent values, at least `least` times each, most frequent first."""
    keys = np.sort(keys)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(edges, len(keys)))
    often = np.flatnonzero(counts >= least)
    often = often[np.argsort(-counts[often], kind="stable")][:most]
    return keys[edges[often]]


def compress(
    ids: np.ndarray, ends: np.ndarray, first: int, *, full: int = 2, least: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their document-end marks and the rules (pairs of symbols).

    Each round replaces the pairs that are most frequent now, all at once and from left to
    right; nonterminal `first` + k stands for rule k. No pair crosses the end of a document.
    After `full` rounds over all pairs, a round counts those with a symbol of the round before;
    rounds end when no such pair occurs `least` times or no symbol is left. A rule costs 12 bytes
    and saves two for each use after the first, so with fewer than seven uses none pays.
    """
    seq, rules = ids.astype(np.uint32), []
    room, fresh, number = max(0, SYMBOLS - first), 0, 0
    while room and len(seq) > 1:
        inside = ~ends[:-1]
        if number >= full:
            inside &= (seq[:-1] >= fresh) | (seq[1:] >= fresh)
        at = np.flatnonzero(inside)
        keys = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        most = room // (full - number) if number < full else room
        # Some room stays for the rounds that follow the full ones.
        chosen = frequent_pairs(keys, least, max(1, most * 3 // 4))
        if not len(chosen):
            break
        # Slots by hash; where two pairs meet in a slot the more frequent one has it.
        slots = lambda k: (k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        own = slots(chosen)
        slot_key = np.full(1 << 20, np.uint64(0xFFFFFFFFFFFFFFFF))
        slot_rule = np.zeros(1 << 20, np.uint32)
        slot_key[own[::-1]] = chosen[::-1]
        slot_rule[own[::-1]] = np.arange(len(chosen), dtype=np.uint32)[::-1]
        found = slots(keys)
        which = np.flatnonzero(slot_key[found] == keys)
        hit = at[which]
        # Of hits that overlap in a row, every other one stands.
        new_run = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
        stands = (np.arange(len(hit)) - run_start) % 2 == 0
        hit, rule = hit[stands], slot_rule[found[which[stands]]]
        used = np.bincount(rule, minlength=len(chosen)) > 0
        fresh = first + sum(map(len, rules))
        rules.append(np.stack([chosen[used] >> np.uint64(32), chosen[used] & np.uint64(0xFFFFFFFF)], 1))
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        seq[hit] = fresh + (np.cumsum(used) - 1)[rule]
        ends = ends.copy()
        ends[hit] = ends[hit + 1]
        seq, ends = seq[keep], ends[keep]
        room, number = room - int(used.sum()), number + 1
    joined = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint64)
    return seq, ends, joined.astype(np.uint32)


def rule_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """For each nonterminal its length in ids."""
    known = np.ones(first + len(rules), np.int64)
    while len(rules):
        lengths = known[rules[:, 0]] + known[rules[:, 1]]
        if (lengths == known[first:]).all():
            break
        known[first:] = lengths
    return known[first:]


def expansions(first: int, rules: np.ndarray) -> np.ndarray:
    """The ids of all nonterminals end to end: pairs are put in their place until none is left."""
    seq = rules.reshape(-1).astype(np.uint32)
    while (non := seq >= first).any():
        at = np.cumsum(1 + non) - (1 + non)
        out = np.empty(at[-1] + 1 + non[-1], np.uint32)
        out[at[~non]] = seq[~non]
        pair = rules[seq[non] - first]
        out[at[non]], out[at[non] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def write_shard(doc_ids: list, docs: list[np.ndarray], first: int) -> bytes:
    """One file: header, document numbers, sizes in ids and in symbols, rules, lengths, symbols."""
    ids = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs], np.int64)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(sizes) - 1] = True
    seq, ends, rules = compress(ids, ends, first)
    symbols = np.diff(np.concatenate([[-1], np.flatnonzero(ends)]))
    lengths = rule_lengths(first, rules)
    parts = [
        struct.pack(HEAD, MAGIC, first, len(rules), len(docs), len(seq)),
        np.array([d is not None for d in doc_ids], "u1").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        sizes.astype("<u4").tobytes(),
        symbols.astype("<u4").tobytes(),
        rules.astype("<u4").tobytes(),
        lengths.astype("<u4").tobytes(),
        seq.astype("<u2" if first + len(rules) <= SYMBOLS else "<u4").tobytes(),
    ]
    return b"".join(parts)


@dataclass
class Shard:
    """A file read back; documents are decoded one by one or all together."""

    doc_ids: list
    sizes: np.ndarray
    symbols: np.ndarray
    first: int
    rules: np.ndarray
    lengths: np.ndarray
    seq: np.ndarray

    @staticmethod
    def read(data: bytes) -> Shard:
        magic, first, n_rules, n_docs, n_symbols = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        there, numbers = take("u1", n_docs), take("<i8", n_docs)
        return Shard(
            [n if ok else None for ok, n in zip(there.tolist(), numbers.tolist(), strict=True)],
            take("<u4", n_docs).astype(np.int64),
            take("<u4", n_docs).astype(np.int64),
            first,
            take("<u4", 2 * n_rules).reshape(-1, 2),
            take("<u4", n_rules).astype(np.int64),
            take("<u2" if first + n_rules <= SYMBOLS else "<u4", n_symbols),
        )

    def expand(self, seq: np.ndarray) -> np.ndarray:
        """Ids of a run of symbols."""
        texts = expansions(self.first, self.rules)
        starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if len(self.lengths) else self.lengths
        seq = seq.astype(np.int64)
        non = seq >= self.first
        size = np.ones(len(seq), np.int64)
        size[non] = self.lengths[seq[non] - self.first]
        out = np.repeat(np.where(non, 0, seq), size).astype(np.uint32)
        where = np.cumsum(size) - size
        if non.any():
            n = size[non]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(where[non], n) + step] = texts[np.repeat(starts[seq[non] - self.first], n) + step]
        return out

    def all_ids(self) -> np.ndarray:
        return self.expand(self.seq)

    def document(self, k: int) -> np.ndarray:
        """Ids of one document without decoding the others."""
        end = int(self.symbols[: k + 1].sum())
        return self.expand(self.seq[end - int(self.symbols[k]) : end])


def write_files(
    docs: DataFrame, tokenizer: str, end: int, first: int, shard_ids: int = 1_000_000
) -> DataFrame:
    """Token files of all documents in ascending doc_id order, saved: part, shard, n_ids, data.

    Null text is empty; its ids are the end id alone. Null doc_id comes first; rows with one
    doc_id are ordered by text. Parts are ranges of doc_id, a shard holds about `shard_ids` ids
    and at least one document. `first` is the size of the vocabulary.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer, BYTE_PIECES, PIECES), TaskContext.get().partitionId()
        numbers, held, size, shard = [], [], 0, 0

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "shard": pa.array([shard], pa.int32()),
                    "n_ids": pa.array([size], pa.int64()),
                    "data": pa.array([write_shard(numbers, held, first)], pa.binary()),
                }
            )

        for batch in batches:
            found = encoder.encode(batch.column(1), end)
            for number, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                numbers.append(number)
                held.append(ids)
                size += len(ids)
                if size >= shard_ids:
                    yield finished()
                    numbers, held, size, shard = [], [], 0, shard + 1
        if held:
            yield finished()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return saved(
        ordered.mapInArrow(shards, "part int, shard int, n_ids long, data binary"), "token-files"
    )


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files.

    `start` counts the ids of all documents before it: sums by part (one row per range of the
    sort), then by shard within the part.
    """
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select(
        F.col("part").alias("__part"),
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"),
    )
    inside = Window.partitionBy("part").orderBy("shard")
    starts = (
        files.select("part", "shard", "n_ids")
        .withColumn("shard_start", F.sum("n_ids").over(inside) - F.col("n_ids"))
        .join(before, F.col("part") == F.col("__part"))
        .select(
            F.col("part").alias("p"),
            F.col("shard").alias("s"),
            (F.col("part_start") + F.col("shard_start")).alias("start"),
        )
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, number = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                shard = Shard.read(batch.column(2)[i].as_py())
                ids = shard.all_ids().astype("<u4")
                ends = np.cumsum(shard.sizes)
                begins = ends - shard.sizes
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                n = len(shard.sizes)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * n, pa.int32()),
                        "shard": pa.array([number] * n, pa.int32()),
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "offset": pa.array(begins, pa.int64()),
                        "n_tokens": pa.array(shard.sizes, pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    read = files.select("part", "shard", "data").mapInArrow(
        documents,
        "part int, shard int, doc_id long, offset long, n_tokens long, ids_crc32 long",
    )
    return read.join(
        starts, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))
    ).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
