"""Byte-level BPE of whole texts that encodes a chunk of text once where texts share it.

Texts are cut into chunks where a rolling hash of the last 16 bytes says so, hence at the same
places of the same content wherever it stands. Documents are dealt to tasks in the order of
their least chunk hash, so copies and near copies meet, and each task encodes a chunk once for
all of them. What the tokenizer does near a chunk's borders depends on what stands beyond, so at
each join the end of the text so far is encoded again together with ever more of the next chunk,
until it has a border between two pieces where the chunk by itself has one too. From such a
border on both encodings agree, up to the chunk's own uncertain end.

A piece is what no token ever leaves: a word with one blank before it, or white space, or a
special token's string, which counts as that token, as in the library's own encoding.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import new_name, text_of
from pulsemart.llm.tokens import BYTE_PIECES, Encoder, byte_letters

#: Bytes that the rolling hash looks at, a power of two; the factor of its polynomial.
WINDOW, FACTOR = 16, 0x9E3779B97F4A7C15
#: Rows worked on at a time, so that little more than a batch as it came is held.
ROWS = 500
#: A chunk has at least LEAST bytes and 1 << SPREAD more on average.
LEAST, SPREAD = 64, 9
#: How many of a chunk's first borders are on file. Should none of them be a border of the text
#: as well, the chunk is encoded together with what stands before it.
HEADS = 6


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text: where the hash of the 16 bytes before has its top bits
    zero, moved on to the next whole character, and at the end. None for an empty text."""
    n = len(data)
    if not n:
        return []
    out = []
    if n > WINDOW + LEAST:
        hashes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        width, factor = 1, FACTOR
        while width < WINDOW:  # hashes of twice the width from two neighbours
            hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
            width, factor = 2 * width, factor * factor % (1 << 64)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        ends = np.flatnonzero(hashes >> np.uint64(64 - SPREAD) == 0) + WINDOW
        last = 0
        for end in ends.tolist():
            while end < n and data[end] & 0xC0 == 0x80:
                end += 1
            if end - last >= LEAST and end < n:
                out.append(last := end)
    out.append(n)
    return out


def chunks(text: str) -> list[str]:
    data, start, out = text.encode(), 0, []
    for end in cuts(data):
        out.append(data[start:end].decode())
        start = end
    return out


class Chunk(NamedTuple):
    """A chunk encoded by itself: ids as bytes, its first borders by character with their place in
    the ids, and its last border that nothing behind the chunk can move."""

    ids: bytes
    heads: dict[int, int]
    tail: int
    tail_ids: int


class Pieces(Encoder):
    """Ids of pieces, those of special tokens included; pieces over 64 characters are not kept."""

    def __init__(self, path: str, most: int) -> None:
        super().__init__(path, BYTE_PIECES, most)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("special tokens that depend on what stands beside them")
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split

    def __missing__(self, piece: str) -> bytes:
        if len(piece) <= 64 and piece not in self.special:
            return super().__missing__(piece)
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return self.special.get(piece) or np.array(ids, "<u4").tobytes()

    def cut(self, text: str) -> list[str]:
        """The pieces of a text that starts at a border."""
        if not any(s in text for s in self.special):
            return self.split(text)
        out = []
        for part in self.at_special(text):
            out += [part] if part in self.special else self.split(part)
        return out


class Reuse:
    """Encodes texts by chunks and remembers chunks up to a number of bytes, and pieces.

    When the chunks met pass half of `most_bytes`, those before are kept for one more half; a
    chunk that comes back later is encoded again. `encoded` and `reused` count chunks.
    """

    def __init__(self, path: str, most_bytes: int = 32 << 20, most_pieces: int = 200_000) -> None:
        self.pieces = Pieces(path, most_pieces)
        self.split, self.ids_of = self.pieces.cut, self.pieces.__getitem__
        #: A border this far from an open end stays, whatever follows.
        self.margin = max(map(len, self.pieces.special), default=0) + 2
        self.most_bytes, self.held_bytes = most_bytes, 0
        self.known: dict[str, Chunk] = {}
        self.older: dict[str, Chunk] = {}
        self.encoded = self.reused = 0

    @staticmethod
    def of(path: str) -> Reuse:
        """This worker process's own, so that later tasks need not read the tokenizer again."""
        store = sys.modules.setdefault("_chunk_reuse", types.ModuleType("_chunk_reuse"))
        if path not in vars(store):
            vars(store)[path] = Reuse(path)
        return vars(store)[path]

    def chunk(self, text: str) -> Chunk:
        if (found := self.known.get(text)) is not None:
            self.reused += 1
            return found
        if (found := self.older.get(text)) is not None:
            self.reused += 1
        else:
            self.encoded += 1
            found = self.encode_chunk(text)
        self.known[text] = found
        self.held_bytes += len(text) + len(found.ids) + 800
        if 2 * self.held_bytes > self.most_bytes:
            self.older, self.known, self.held_bytes = self.known, {}, 0
        return found

    def encode_chunk(self, text: str) -> Chunk:
        pieces = self.split(text)
        coded = list(map(self.ids_of, pieces))
        ids = b"".join(coded)
        certain = len(text) - self.margin
        heads: dict[int, int] = {}
        end = mark = 0
        for piece, part in zip(pieces, coded, strict=True):
            end, mark = end + len(piece), mark + len(part)
            if end > certain or len(heads) == HEADS:
                break
            heads[end] = mark
        end, mark, k = len(text), len(ids), len(pieces)
        while end > certain and k:
            k -= 1
            end, mark = end - len(pieces[k]), mark - len(coded[k])
        return Chunk(ids, heads, end, mark)

    def join(self, open_end: str, text: str, chunk: Chunk) -> tuple[list[bytes], int] | None:
        """Ids from the open end to a border inside the next chunk that both encodings have, and
        that border; None if none of the chunk's first ones is."""
        look, last = 32, max(chunk.heads)
        while True:
            pieces = self.split(open_end + text[:look])
            reach = min(look, len(text)) - self.margin
            for k, end in enumerate(accumulate(map(len, pieces))):
                inside = end - len(open_end)
                if inside > reach:
                    break
                if inside in chunk.heads:
                    return list(map(self.ids_of, pieces[: k + 1])), inside
            if reach >= last or look >= len(text):
                return None
            look *= 2

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        open_end: list[str] = []  # text behind the last certain border
        start = True
        for part in chunks(text):
            chunk = self.chunk(part)
            if start:
                out.append(chunk.ids[: chunk.tail_ids])
                open_end, start = [part[chunk.tail :]], False
                continue
            found = None
            if chunk.heads:
                open_end = ["".join(open_end)]
                found = self.join(open_end[0], part, chunk)
            if found is None:
                open_end.append(part)
                continue
            mended, border = found
            out += mended
            out.append(chunk.ids[chunk.heads[border] : chunk.tail_ids])
            open_end = [part[chunk.tail :]]
        out += map(self.ids_of, self.split("".join(open_end)))
        return b"".join(out)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def dealt(rows: DataFrame, text: str) -> DataFrame:
    """The rows, with null texts empty, in partitions by their text's least chunk hash.

    Ranges of it are cut as evenly as Spark's sample allows, and rows of one hash are told apart
    by their place in the input, so a large group of copies spreads over several partitions.
    """
    key, place = new_name(rows.columns, "key"), new_name(rows.columns, "place")
    rows = rows.withColumn(text, text_of(text))
    names = rows.columns

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            keys = []
            for value in batch.column(names.index(text)):
                data, start, least = value.as_buffer().to_pybytes(), 0, 1 << 62
                for end in cuts(data):
                    least = min(least, xxhash.xxh3_64_intdigest(data[start:end]) >> 2)
                    start = end
                keys.append(least)
            places = pa.array(range(seen, seen + len(keys)), pa.int64())
            seen += len(keys)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.int64()), places], [*names, key, place]
            )

    schema = rows.withColumn(key, F.lit(0).cast("long")).withColumn(place, F.lit(0).cast("long"))
    return (
        rows.mapInArrow(keyed, schema.schema)
        .repartitionByRange(key, place)
        .sortWithinPartitions(key, place)
        .drop(key, place)
    )


def encode(rows: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id_column and ids of every row: binary, little-endian unsigned 32-bit integers.

    The ids are those of the tokenizers library for the whole text with add_special_tokens off,
    for a byte-level tokenizer without normaliser. A null text counts as empty and has no ids;
    repeated rows each get a row, an empty table none; other columns are not read. A task holds
    one batch of texts and the chunks remembered.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reuse = Reuse.of(path)
        for part in slices(batches):
            found = [reuse.encode(t.as_py()) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(found, pa.binary())], ["id", "ids"]
            )

    picked = rows.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return (
        dealt(picked, "text").mapInArrow(work, "id long, ids binary").withColumnRenamed("id", id_column)
    )


def byte_strings(path: str) -> list[bytes | None]:
    """The bytes that each id stands for; None for an id that is not used."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    bytes_of = {letter: bytes([b]) for b, letter in byte_letters().items()}
    out: list[bytes | None] = [None] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        if all(c in bytes_of for c in token):
            out[i] = b"".join(bytes_of[c] for c in token)
        else:
            out[i] = token.encode()
    return out


def decoder(path: str) -> Callable[[bytes], str]:
    """Ids to text, special tokens included; ids without a token are passed over, and bytes that
    are no UTF-8 become replacement characters."""
    table = [b or b"" for b in byte_strings(path)]

    def text_of_ids(ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and int(numbers.max()) >= len(table):
            numbers = numbers[numbers < len(table)]
        return b"".join(map(table.__getitem__, numbers.tolist())).decode("utf-8", "replace")

    return text_of_ids


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text that their ids stand for in place of the ids; null stays null."""
    names = [c for c in rows.columns if c != ids]
    if text in names:
        raise ValueError(f"there is a column {text} already")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = decoder(path)
        for part in slices(batches):
            texts = [None if v is None else read(v) for v in part.column("ids").to_pylist()]
            others = [part.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*others, pa.array(texts, pa.string())], [*names, text])

    picked = rows.select(*names, F.col(ids).alias("ids"))
    schema = rows.select(*names, F.lit("").alias(text)).schema
    for field in schema:
        field.nullable = True
    return picked.mapInArrow(work, schema)
