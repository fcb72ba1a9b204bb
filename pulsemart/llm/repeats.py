"""Removal of long byte strings that occur more than once, over sampled suffixes.

A suffix array over every byte is out of reach (see the README), so only sampled suffixes are
sorted. The sample is a difference cover that depends on content: in each window of COVER
positions the one with the least hash is sampled, so two equal 400-byte strings have a sampled
position at the same place. Sampled suffixes are named by the hash of their start. Names that
occur once fall away, the rest are named again by their 400-byte prefix and compared; last, the
suffixes between samples at the borders of what repeats are merged in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import mixed, runs, saved, saved_by, text_of
from pulsemart.llm.counts import corpus_counts, counts_told, told_by_bucket, with_counts
from pulsemart.operators.sizes import broadcast_if_small

LENGTH = 400
COVER = 128
GRAM = 16
#: Bytes of a sampled suffix that every 400-byte string with this sample contains.
CORE = LENGTH - COVER
#: Places of strings around a sample that are told apart together first.
STRIDE = 16
BLOCK_NAMES = 500_000
BUCKET_NAMES = 2_000_000

Batches = Iterator[pa.RecordBatch]


def anchors(text: bytes) -> np.ndarray:
    """For each 400-byte string the leftmost least hash among its first COVER positions."""
    n = len(text) - LENGTH + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    count = n + COVER - 1
    words = np.ndarray((count + 8,), "<u8", text, 0, (1,))
    # Low bits hold the place: where hashes tie, the leftmost is the least.
    key = mixed(words[:count] * np.uint64(0x9E3779B97F4A7C15) + words[8 : count + 8])
    key = (key & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
    step = 1
    while step < COVER:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def turns(at: np.ndarray) -> np.ndarray:
    """Where another anchor begins."""
    return np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])[: len(at)])


def sampled(text: bytes) -> np.ndarray:
    """Sampled positions: the anchors, each once."""
    at = anchors(text)
    return at[turns(at)]


def names(text: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` bytes from each position."""
    view = memoryview(text)
    named = xxhash.xxh3_64_intdigest
    return np.fromiter((named(view[i : i + length]) for i in at.tolist()), np.uint64, len(at))


def borders(n_bytes: int, at: np.ndarray, repeated: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Starts of strings that may repeat, are not known to, and would add to what is covered.

    Between two samples whose strings both repeat everything is covered already. Elsewhere a
    string can only repeat if one of its first COVER positions is a sample named more than once
    (`known`).
    """
    last = n_bytes - LENGTH
    edges = np.concatenate([[-1], at[at <= last], [last + 1]])
    sure = np.concatenate([[False], repeated[at <= last], [False]])
    open_ = np.flatnonzero(~(sure[:-1] & sure[1:]))
    parts = [np.arange(edges[k] + 1, edges[k + 1] + (not sure[k + 1])) for k in open_]
    starts = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = starts[starts <= last]
    return starts[within(starts, at[known])]


def within(starts: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """Whether one of the samples is among the COVER positions from each start."""
    following = np.searchsorted(samples, starts)
    near = np.append(samples, np.iinfo(np.int64).max)[following]
    return near - COVER < starts


def asked_by(starts: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """Whether each sample is among the COVER positions from one of the starts."""
    before = np.searchsorted(starts, samples, "right") - 1
    near = np.append(starts, -COVER)[before]
    return (before >= 0) & (samples < near + COVER)


def spans(starts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by 400-byte strings at these starts."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + LENGTH]))
    begin, end = starts[new], starts[np.append(new[1:], len(starts)) - 1] + LENGTH
    return list(zip(begin.tolist(), end.tolist(), strict=True))


def without(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for begin, end in cut:
        out.append(text[at:begin])
        at = end
    return b"".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_key, n_bytes, sha256, at, names of every row, saved."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                out = []
                for text in part.column(1).to_pylist():
                    data = text.encode("utf-8", "surrogatepass")
                    at = sampled(data)
                    out.append(
                        (
                            row,
                            xxhash.xxh3_128_digest(data),
                            len(data),
                            hashlib.sha256(data).hexdigest(),
                            at.astype("<u4").tobytes(),
                            names(data, at, CORE).astype("<u8").tobytes(),
                        )
                    )
                    row += 1
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *arrays],
                    ["doc_id", "row", "text_key", "n_bytes", "sha256", "at", "names"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    return saved(
        rows.mapInArrow(
            scanned,
            "doc_id long, row long, text_key binary, n_bytes long, sha256 string, at binary, "
            "names binary",
        ),
        "sampled",
    )


def in_blocks(rows: DataFrame, named: Callable[[Batches], Batches] | None = None) -> DataFrame:
    """Rows of t, hashes and perhaps weights packed in blocks of about BLOCK_NAMES hashes: block,
    data, n.

    `named` makes these rows from others in the same worker: two steps of Python in one task would
    take two workers, and all that an executor ever had stay and hold what they remember.
    """
    size = BLOCK_NAMES

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        found: list[bytes] = []
        adds: list[bytes] = []
        held = 0

        def finished() -> pa.RecordBatch:
            head = np.array([len(ids), *ids, *(len(f) // 8 for f in found)], "<i8").tobytes()
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block], pa.int64()),
                    "data": pa.array([b"".join([head, *found, *adds])], pa.binary()),
                    "n": pa.array([held], pa.int64()),
                }
            )

        for batch in named(batches) if named else batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            weighted = columns if len(columns) > 2 else [*columns, [None] * batch.num_rows]
            for t, hashes, weights in zip(*weighted, strict=True):
                ids.append(t)
                found.append(hashes)
                adds.append(weights or b"\1" * (len(hashes) // 8))
                held += len(hashes) // 8
                if held >= size:
                    yield finished()
                    ids, found, adds, held, block = [], [], [], 0, block + 1
        if ids:
            yield finished()

    return rows.mapInArrow(packed, "block long, data binary, n long")


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    ids, sizes = np.frombuffer(data, "<i8", 2 * n, 8).reshape(2, n)
    held = int(sizes.sum())
    hashes = np.frombuffer(data, "<u8", held, 8 + 16 * n)
    return ids, sizes, hashes, np.frombuffer(data, "u1", held, 8 + 16 * n + 8 * held)


def frequent(
    rows: DataFrame,
    least: int = 2,
    totals: bool = False,
    named: Callable[[Batches], Batches] | None = None,
) -> DataFrame:
    """t, flags for rows of t, hashes: which of them occur `least` times or more in all rows.

    With weights behind (a byte per hash) each occurrence counts as much as that. Rows without
    any such hash are left out. With `totals` the flags are how often each occurs, in 32 bits.
    `named` makes the rows from others on the way.
    """
    blocks = saved(in_blocks(rows, named), "named")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(8, -(-total // BUCKET_NAMES))
    blocks = blocks.drop("n")
    told = corpus_counts(blocks, lambda data, _: [(0, *unpacked(data)[2:])], n_buckets)

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["block"]):
            ids, sizes, hashes, _ = unpacked(group["data"][0].as_py())
            total = counts_told(hashes, told_by_bucket(group), 0, n_buckets)
            flags = np.minimum(total, 0xFFFFFFFF).astype("<u4") if totals else (total >= least).astype("u1")
            ends = np.cumsum(sizes)[:-1]
            parts = zip(ids.tolist(), np.split(total >= least, ends), np.split(flags, ends), strict=True)
            kept = [(t, p) for t, some, p in parts if some.any()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t for t, _ in kept], pa.int64()),
                    pa.array([p.tobytes() for _, p in kept], pa.binary()),
                ],
                ["t", "flags"],
            )

    return with_counts(blocks, told).mapInArrow(flagged, "t long, flags binary")


def mask(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "u1").astype(bool)


CANDIDATE = (
    "t long, text_key binary, copies long, at binary, flags binary, data binary, hashes binary"
)
FINISHED = "text_key binary, spans array<struct<begin:long,end:long>>, kept_sha256 string"


def rows_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """The columns as tuples, some hundred rows at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 300):
            part = batch.slice(begin, 300)
            yield list(zip(*(part.column(n).to_pylist() for n in names), strict=True))


def batch_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the 400-byte prefixes of sampled suffixes whose start is named twice."""
    names_in = ["t", "text_key", "copies", "at", "flags", "text"]
    for rows in rows_of(batches, names_in):
        out = []
        for t, key, copies, at, flags, text in rows:
            data = text.encode("utf-8", "surrogatepass")
            if xxhash.xxh3_128_digest(data) != key:  # another text under this doc_id
                continue
            where = np.frombuffer(at, "<u4").astype(np.int64)
            own = where[mask(flags) & (where <= len(data) - LENGTH)]
            out.append((t, key, copies, at, flags, data, names(data, own, LENGTH).tobytes()))
        kinds = [pa.int64(), pa.binary(), pa.int64(), *[pa.binary()] * 4]
        yield batch_of(out, ["t", "text_key", "copies", "at", "flags", "data", "hashes"], kinds)


def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which samples stand in strings at a border: wherever these are, they are compared."""
    for rows in rows_of(batches, ["t", "copies", "n_bytes", "at", "names", "flags", "sure"]):
        out = []
        for t, copies, n_bytes, at, named, flags, sure in rows:
            at, repeated, twice = places(n_bytes, at, flags, sure)
            own = at[twice]
            starts = borders(n_bytes, at, repeated, twice) if copies == 1 else at[:0]
            weights = asked_by(starts, own).astype("u1").tobytes()
            out.append((t, np.frombuffer(named, "<u8")[twice].tobytes(), weights))
        yield batch_of(out, ["t", "hashes", "weights"], [pa.int64(), pa.binary(), pa.binary()])


def stretches(data: bytes, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings with the samples asked for as anchors, STRIDE places of the sample at a time.

    First and last start of each such stretch, and where its inner part starts: what all strings
    with the sample at one of these places have in common. It is the same in every text.
    """
    at = anchors(data)
    first = turns(at)
    last = np.append(first[1:], len(at)) - 1
    sample, first, last = at[first][asked], first[asked], last[asked]
    # `place` is how far the sample is from the start of its string.
    least, most = (sample - last) // STRIDE, (sample - first) // STRIDE
    n = most - least + 1
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    inner = np.repeat(sample - STRIDE * least, n) - STRIDE * step
    return (
        np.maximum(np.repeat(first, n), inner - STRIDE + 1),
        np.minimum(np.repeat(last, n), inner),
        inner,
    )


def has_outer(n_bytes: int, inner: np.ndarray) -> np.ndarray:
    """Whether the string that holds all strings of a stretch lies within the text."""
    return (inner >= STRIDE - 1) & (inner <= n_bytes - LENGTH)


def asked_samples(flags: bytes, asked: bytes) -> np.ndarray:
    return np.flatnonzero(mask(flags))[mask(asked)]


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings around the samples asked for, by stretch.

    Where the inner part of a stretch occurs once, none of its strings repeats; where the outer
    one, from the first byte of any to the last, repeats, all do, and as often as it if the inner
    part occurs nowhere else. The others are named one by one.
    """
    for rows in rows_of(batches, ["t", "flags", "data", "asked"]):
        out = []
        for t, flags, data, asked in rows:
            # Stretches of two samples may have one inner part, which counts as one place.
            inner = np.unique(stretches(data, asked_samples(flags, asked))[2])
            outer = inner[has_outer(len(data), inner)] - STRIDE + 1
            found = [names(data, inner, LENGTH - STRIDE + 1), names(data, outer, LENGTH + STRIDE - 1)]
            out.append((t, np.concatenate(found).astype("<u8").tobytes()))
        yield batch_of(out, ["t", "hashes"], [pa.int64(), pa.binary()])


def undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of stretches that are not settled, and the ends of those that repeat."""
    for rows in rows_of(batches, ["t", "flags", "data", "asked", "told"]):
        out = []
        for t, flags, data, asked, told in rows:
            first, last, inner = stretches(data, asked_samples(flags, asked))
            places_asked, which = np.unique(inner, return_inverse=True)
            told = np.frombuffer(told, "<u4").astype(np.int64)
            there, outer = has_outer(len(data), places_asked), np.zeros(len(places_asked), np.int64)
            outer[there] = told[len(places_asked) :]
            some, outer = told[: len(places_asked)][which], outer[which]
            whole = outer > 1
            # Where other strings have the inner part too, they are to be met.
            open_ = np.flatnonzero((some > 1) & ~(whole & (outer == some)))
            n = last[open_] - first[open_] + 1
            starts = np.arange(n.sum()) + np.repeat(first[open_] - (np.cumsum(n) - n), n)
            held = np.concatenate([first[whole], last[whole]])
            out.append(
                (
                    t,
                    starts.astype("<u4").tobytes(),
                    names(data, starts, LENGTH).astype("<u8").tobytes(),
                    held.astype("<u4").tobytes(),
                )
            )
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield batch_of(out, ["t", "starts", "hashes", "held"], kinds)


def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans to remove, and the hash of what stays."""
    names_in = ["text_key", "data", "at", "flags", "sure", "starts", "more", "held"]
    for rows in rows_of(batches, names_in):
        out = []
        for key, data, at, flags, sure, starts, more, held in rows:
            at, repeated, _ = places(len(data), at, flags, sure)
            begin = at[repeated]
            if held is not None:
                begin = np.concatenate([begin, np.frombuffer(held, "<u4")])
            if more is not None:
                begin = np.concatenate([begin, np.frombuffer(starts, "<u4")[mask(more)]])
            if len(begin):
                cut = spans(begin)
                kept = hashlib.sha256(without(data, cut)).hexdigest()
                out.append((key, [{"begin": a, "end": b} for a, b in cut], kept))
        pair = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield batch_of(out, ["text_key", "spans", "kept_sha256"], [pa.binary(), pair, pa.string()])


def text_id(sha: Column | str) -> Column:
    """64-bit hash of doc_id and text, the same wherever a row is read."""
    return F.xxhash64("doc_id", sha)


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What repeats, by distinct text, and the texts of all rows.

    First frame: text_key, spans (of removed bytes), kept_sha256 for texts that lose something.
    Second: doc_id, text_key, n_bytes, sha256 by row. Equal texts are one: if they have 400 bytes,
    two of them repeat from end to end.
    """
    rows = scan(docs)
    texts = rows.groupBy("text_key").agg(F.min("row").alias("first"), F.count("*").alias("copies"))
    # Samples and names move for this once; what follows reads them from files.
    first = saved(
        rows.join(saved(texts.select("first", "copies"), "texts"), F.col("row") == F.col("first"))
        .withColumn("t", text_id("sha256"))
        .drop("row", "first"),
        "first",
    )
    # A text with copies repeats as a whole; it is asked too, for what others share with it.
    known = saved(
        frequent(
            first.where(F.length("names") > 0).select("t", F.col("names").alias("hashes"))
        ),
        "known",
    )
    wanted = first.select("t", "text_key", "copies", "at").join(known, "t")
    text = text_of("text")
    plain = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .where(F.octet_length("text") >= LENGTH)  # a shorter one has no sample
        .select(text_id(F.sha2(F.col("text").cast("binary"), 256)).alias("__t"), "text")
    )
    # By the text too: any number of rows may share a doc_id, or have none. This is the one time
    # that texts move; they stay in buckets of t, and all that is told of them comes there.
    texts_of = (
        plain.join(wanted.hint("merge"), F.col("__t") == F.col("t"))
        .select("t", "text_key", "copies", "at", "flags", "text")
        .mapInArrow(prefixes, CANDIDATE)
    )
    own, candidates = saved_by(texts_of, "t", "candidates")
    # Only a text with copies can have come more than once here.
    every = own.dropDuplicates(["t"])
    some = F.length("hashes") > 0
    sure = saved(frequent(every.where(some).select("t", "hashes")), "sure").withColumnRenamed(
        "flags", "sure"
    )
    # What is asked depends on names and places alone; texts are not moved for it.
    small = first.select("t", "copies", "n_bytes", "at", "names").join(known, "t")
    asked = frequent(small.join(sure, "t", "left"), 1, named=questions)
    asked = saved(asked.withColumnRenamed("flags", "asked"), "asked")
    around = every.select("t", "flags", "data").join(asked, "t")
    told = frequent(around, totals=True, named=answers)
    merged = saved(
        around.join(told.withColumnRenamed("flags", "told"), "t").mapInArrow(
            undecided, "t long, starts binary, hashes binary, held binary"
        ),
        "merged",
    )
    more = saved(frequent(merged.select("t", "hashes")), "more").withColumnRenamed("flags", "more")
    more = merged.drop("hashes").join(more, "t", "left")
    told = sure.join(more, "t", "full")
    cut = (
        own.where("copies = 1")
        .select("t", "text_key", "data", "at", "flags")
        .join(told, "t")
        .select("text_key", "data", "at", "flags", "sure", "starts", "more", "held")
        .mapInArrow(finished, FINISHED)
    )
    copied = (
        first.where((F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH))
        .select(
            "text_key",
            F.array(
                F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end"))
            ).alias("spans"),
            F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"),
        )
    )
    found = saved(cut.unionByName(copied), "spans")
    docs.sparkSession.sql(f"DROP TABLE {candidates}")
    return found, rows.drop("at", "names")


def places(
    n_bytes: int, at: bytes, flags: bytes, sure: bytes | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples, whether the 400 bytes from each repeat, and whether its start is named twice."""
    where = np.frombuffer(at, "<u4").astype(np.int64)
    twice = mask(flags)
    repeated = np.zeros(len(where), bool)
    if sure is not None:
        repeated[np.flatnonzero(twice & (where <= n_bytes - LENGTH))] = mask(sure)
    return where, repeated, twice


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per row of documents.

    Texts are judged as UTF-8 bytes, null as empty. A byte goes if a 400-byte string that covers
    it also starts anywhere else, in the same text or another row; a repeated row is such a row.
    Texts under 400 bytes lose nothing. Other columns are ignored.
    """
    found, rows = repeats(docs)
    found = found.withColumnRenamed("text_key", "__key")
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return rows.join(found, F.col("text_key") == F.col("__key"), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )


def cut(docs: DataFrame) -> DataFrame:
    """The documents with what repeats taken out of their texts, in the same columns.

    A character that loses some of its bytes goes as a whole. A column n_chars is counted again.
    Texts that lose nothing stay as they are, null included; no row is dropped.
    """
    found, rows = repeats(docs)
    keyed = saved(
        found.join(rows.select("text_key", "sha256").distinct(), "text_key").select(
            F.col("sha256").alias("__sha"), "spans"
        ),
        "spans",
    )
    names = docs.columns
    joined = docs.select(
        F.struct(*names).alias("__row"), F.sha2(text_of("text"), 256).alias("__key")
    ).join(broadcast_if_small(keyed), F.col("__key") == F.col("__sha"), "left")
    lost = F.col("spans").isNotNull()

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 300):
                part = batch.slice(begin, 300)
                texts = []
                columns = (part.column(i).to_pylist() for i in (1, 2))
                for text, spans in zip(*columns, strict=True):
                    if spans:
                        data = text.encode("utf-8", "surrogatepass")
                        pairs = [(s["begin"], s["end"]) for s in spans]
                        text = without(data, pairs).decode("utf-8", "ignore")
                    texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], ["__row", "__text"]
                )

    schema = joined.select("__row").schema.add("__text", "string")
    done = joined.select("__row", "__row.text", F.when(lost, F.col("spans"))).mapInArrow(
        shortened, schema
    )
    new = {"text": F.col("__text")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(
            F.col("__text") == F.col("__row.text"), F.col("__row.n_chars")
        ).otherwise(F.length("__text")).cast(kind)
    return done.select(*(new.get(n, F.col(f"__row.`{n}`")).alias(n) for n in names))
