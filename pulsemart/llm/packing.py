"""Best-fit packing of token pieces into sequences under several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import BATCH_ROWS, release, saved, setting, text_of
from pulsemart.llm.tokens import WORD_PIECES, Encoder

#: Rows that one task packs. Groups are equal shares of all rows, so their number grows instead.
GROUP_ROWS = 16_000
#: Bytes of ids that one task packs, where ids travel with the pieces.
GROUP_BYTES = 8 << 20


def best_fit(
    demands: np.ndarray,
    capacity: Sequence[float],
    weights: Sequence[float],
    score: str = "residual",
) -> np.ndarray:
    """Bin of each item: largest first, each into the open bin with the best score.

    `demands` has one row per item and one column per capacity. A bin qualifies if every
    capacity has room. "residual" takes the least weighted norm of the room that would be left,
    "dot" the greatest weighted product of demand and room. Ties go to the oldest bin. An item
    over a capacity by itself gets a bin of its own.
    """
    capacity, weights = np.asarray(capacity, float), np.asarray(weights, float)
    share = demands / capacity
    order = np.argsort(-(share * weights).sum(1), kind="stable")
    least = share.min(0) if len(share) else capacity
    bins = np.zeros(len(demands), np.int64)
    room = np.empty((64, len(capacity)))
    names = np.empty(64, np.int64)
    used = made = 0
    for item in order:
        need = share[item]
        fits = np.flatnonzero((room[:used] >= need - 1e-12).all(1))
        if len(fits):
            if score == "dot":
                at = fits[np.argmax(room[fits] @ (need * weights))]
            else:
                at = fits[np.argmin((((room[fits] - need) ** 2) * weights).sum(1))]
            room[at] -= need
            bins[item] = names[at]
            if (room[at] < least - 1e-12).any():  # nothing fits any more
                used -= 1
                room[at : used], names[at : used] = room[at + 1 : used + 1], names[at + 1 : used + 1]
        else:
            if used == len(room):
                room, names = np.concatenate([room, room]), np.concatenate([names, names])
            bins[item] = names[used] = made
            room[used] = 1.0 - need
            made += 1
            used += not (room[used] < least - 1e-12).any()
    return bins


def cut(docs: DataFrame, tokenizer: str, end: int, size: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `size` ids: doc_id, piece, start, length, ids_crc32, salt, ids.

    Null text is empty and yields the end id alone. Only documents longer than `size` are cut.
    `salt` counts rows within a task, so that repeated rows spread. `ids` (little-endian unsigned
    32-bit) is null unless asked for.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, salt = Encoder.of(tokenizer, WORD_PIECES), 0
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt", "ids"]

        def finished(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
            )

        for batch in release(batches):
            rows = []
            found = encoder.encode(batch.column(1), end)
            for doc, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                for k, start in enumerate(range(0, len(ids), size)):
                    piece = ids[start : start + size].tobytes()
                    rows.append(
                        (doc, k, start, len(piece) // 4, zlib.crc32(piece), salt, with_ids and piece or None)
                    )
                    salt += 1
                    if len(rows) == 1_000:
                        yield finished(rows)
                        rows = []
            if rows:
                yield finished(rows)

    return docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text")).mapInArrow(
        pieces,
        "doc_id long, piece int, start long, length long, ids_crc32 long, salt long, ids binary",
    )


def pack(
    pieces: DataFrame,
    size: int,
    *,
    max_docs: int | None = None,
    max_attention: int | None = None,
    weights: Sequence[float] = (1.0, 0.0, 0.0),
    score: str = "residual",
) -> DataFrame:
    """Pieces with sequence_id and offset in place of salt.

    A sequence holds at most `size` ids, `max_docs` pieces and an attention cost (the sum of
    squared lengths) of `max_attention`; by default the last two never bind. Pieces are dealt
    evenly to groups of about GROUP_ROWS, or of GROUP_BYTES of ids, by hash and each group is packed
    by itself, which costs about one sequence a group at most. An empty table stays empty.
    """
    capacity = (size, max_docs or size, max_attention or size * size)
    # Whole texts go to the workers here; a batch of the usual size holds tens of MB of them.
    with setting(pieces.sparkSession, BATCH_ROWS, "2000"):
        pieces = saved(pieces, "pieces")
    rows, held = pieces.agg(F.count(F.lit(1)), F.sum(F.octet_length("ids"))).first()
    groups = max(1, -(-rows // GROUP_ROWS), -(-(held or 0) // GROUP_BYTES))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        # Largest first in any case; the rest of the order makes a rerun give the same bins.
        rows = rows.sort_values(["length", "doc_id", "piece", "salt"], ascending=[False, True, True, True])
        length = rows["length"].to_numpy()
        full = length >= size
        bins = np.arange(len(rows))
        demands = np.stack([length, np.ones_like(length), length * length], 1)[~full]
        bins[~full] = best_fit(demands, capacity, weights, score) + full.sum()
        rows["sequence_id"] = (np.int64(rows["group"].iloc[0]) << np.int64(32)) + bins
        rows["offset"] = length
        rows["offset"] = rows.groupby("sequence_id")["offset"].cumsum() - length
        return rows[[*names, "sequence_id", "offset"]]

    names = [c for c in pieces.columns if c != "salt"]
    schema = pieces.select(*names).schema.add("sequence_id", "long").add("offset", "long")
    keyed = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "salt"), F.lit(groups)))
    return keyed.groupBy("group").applyInPandas(packed, schema)
