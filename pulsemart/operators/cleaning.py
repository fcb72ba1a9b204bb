"""Splitting messages by topic, shaping payloads and removing duplicates.

Everything but `deduplicate(order_by=...)` works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulsemart.functions.columns import epoch_to_timestamp, parse_json
from pulsemart.operators.quality import enforce
from pulsemart.operators.topics import Topic


def split_topic(messages: DataFrame, topic: Topic) -> DataFrame:
    """The payload columns of one topic's messages, unparsed rows included as NULLs."""
    payload = parse_json("value", topic.payload_schema)
    return messages.where(F.col("topic") == topic.name).select(payload.alias("body")).select("body.*")


def shape(parsed: DataFrame, topic: Topic) -> DataFrame:
    """Payload columns with epoch seconds turned into `timestamp`, in place."""

    def cleaned(name: str) -> Column:
        if name == topic.time_column:
            return epoch_to_timestamp(name).alias("timestamp")
        return F.col(name)

    return parsed.select(*[cleaned(name) for name in parsed.columns])


def deduplicate(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key.

    Without `order_by` any of the duplicates may stay. With it (batch only) the row with
    the smallest values stays, NULLs last, ties settled by the other columns. Both combine
    on the map side first, so a key with very many copies never meets in one task.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    others = [c for c in df.columns if c not in keys]
    if others == list(order_by) and len(others) == 1:
        picked = df.groupBy(*keys).agg(F.min(others[0]).alias(others[0]))
    else:
        ranked = [*order_by, *(c for c in others if c not in order_by)]
        rank = [part for c in ranked for part in (F.col(c).isNull(), F.col(c).alias(c))]
        best = F.min(F.struct(*(p.alias(f"r{i}") for i, p in enumerate(rank))))
        position = {c: f"r{2 * i + 1}" for i, c in enumerate(ranked)}
        picked = (
            df.groupBy(*keys)
            .agg(best.alias("best"))
            .select(*keys, *(F.col(f"best.{position[c]}").alias(c) for c in others))
        )
    return picked.select(*df.columns)


def collapse_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats of a key that sit next to each other in a task, before any shuffle.

    Streaming de-duplication has no map-side combine: all copies of one key would travel to
    one task. This keeps the first copy per Arrow batch, so only a handful do. Rows with
    different keys are never touched.
    """
    names = list(keys)

    def first_copies(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch]).select(names)
            table = table.append_column("__row", pa.array(np.arange(batch.num_rows)))
            kept = table.group_by(names).aggregate([("__row", "min")])["__row_min"]
            if len(kept) == batch.num_rows:
                yield batch
            else:
                yield from pa.Table.from_batches([batch]).take(kept).to_batches()

    return df.mapInArrow(first_copies, df.schema)


def clean(
    parsed: DataFrame,
    topic: Topic,
    order_by: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Shaped rows that pass the topic's rules, one per key.

    An `observation` (batch only) receives the rule counts as the rows flow by. Counting all
    rows, it keeps the rules from being applied in the scan.
    """
    shaped = shape(parsed, topic)
    if topic.rules:
        shaped = enforce(shaped, topic.rules, observation)
    return deduplicate(shaped, topic.keys, order_by)
