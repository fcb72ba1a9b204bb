"""Cleaning a stream without losing sight of rows that come too late.

Spark's own de-duplication counts late rows and drops them. Here each micro-batch is told apart by
a watermark that is stepped from batch to batch and on file: what is behind it is kept in a
directory of its own, the rest goes on. The cleaned table itself is the memory of what has been
seen: a batch's rows are held against those of its keys that are not behind the watermark, so
there is no state store, and a batch that is replayed replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemart.constants import WATERMARK_DELAY
from pulsemart.operators.cleaning import deduplicate, shape
from pulsemart.operators.quality import all_pass, keeps
from pulsemart.operators.topics import Topic
from pulsemart.sinks.batches import write_batch

REPORT = "landed LONG, late LONG, dropped LONG, duplicates LONG, kept LONG, newest TIMESTAMP"


@dataclass(frozen=True)
class LateTables:
    """`arrivals`: every shaped row, by batch and by whether it came late. `silver`: the cleaned
    rows by batch. `report`: a row of counts for each batch."""

    arrivals: str
    silver: str
    report: str


def watermark(spark: SparkSession, report: str, batch: int, delay: str):
    """The newest event time of the batches before, less the delay; None before there is any."""
    if not spark.catalog.tableExists(report):
        return None
    newest = spark.table(report).where(F.col("batch") < batch).agg(F.max("newest").alias("t"))
    return newest.select(F.col("t") - F.expr(f"INTERVAL {delay}")).first()[0]


def clean_batch(
    parsed: DataFrame,
    batch: int,
    topic: Topic,
    tables: LateTables,
    delay: str = WATERMARK_DELAY,
    order_by: Sequence[str] | None = None,
) -> None:
    """Clean one micro-batch; landed = late + dropped + duplicates + kept.

    Late is what is not after the watermark; rows without event time never are. Rows on time that
    fail a rule are dropped, copies of rows on time are duplicates, within the batch and of rows
    kept before. All rows move the watermark, those of this batch from the next one on.
    """
    spark, keys = parsed.sparkSession, list(topic.keys)
    if _is_done(spark, tables.report, batch):
        return
    mark = watermark(spark, tables.report, batch, delay)
    shaped = shape(parsed, topic)
    late = F.lit(False) if mark is None else F.coalesce(F.col("timestamp") <= F.lit(mark), F.lit(False))
    arrived = write_batch(shaped.withColumn("late", late), tables.arrivals, batch, ["late"])
    good = deduplicate(
        arrived.where(~F.col("late")).where(keeps(topic.rules)).select(*shaped.columns), keys, order_by
    )
    if spark.catalog.tableExists(tables.silver):
        known = spark.table(tables.silver).where(F.col("batch") < batch)
        if mark is not None and "timestamp" in keys:
            known = known.where((F.col("timestamp") > F.lit(mark)) | F.col("timestamp").isNull())
        known = known.select(*(F.col(k).alias(f"known_{k}") for k in keys))
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in keys))
        good = good.join(known, same, "left_anti")
    kept = write_batch(good, tables.silver, batch).count()
    counts = arrived.agg(
        F.count(F.lit(1)).alias("landed"),
        F.count_if("late").alias("late"),
        F.count_if(~F.col("late") & ~all_pass(topic.rules)).alias("dropped"),
        F.max("timestamp").alias("newest"),
    )
    again = F.col("landed") - F.col("late") - F.col("dropped") - F.lit(kept)
    report = counts.select(
        "landed", "late", "dropped", again.alias("duplicates"), F.lit(kept).cast("long").alias("kept"), "newest"
    )
    # Last: a batch with a report is done.
    write_batch(report, tables.report, batch)


def _is_done(spark: SparkSession, report: str, batch: int) -> bool:
    return spark.catalog.tableExists(report) and not (
        spark.table(report).where(F.col("batch") == batch).isEmpty()
    )


def start(
    parsed: DataFrame,
    topic: Topic,
    tables: LateTables,
    checkpoint: str,
    delay: str = WATERMARK_DELAY,
    every: str | None = None,
    order_by: Sequence[str] | None = None,
) -> StreamingQuery:
    """Clean a stream of a topic's payload columns batch by batch, late rows kept apart."""
    if topic.time_column is None:
        raise ValueError(f"{topic.name} has no event time, so no row of it is late")
    when = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        parsed.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**when)
        .foreachBatch(lambda rows, batch: clean_batch(rows, batch, topic, tables, delay, order_by))
        .start()
    )


def late_rows(spark: SparkSession, tables: LateTables) -> DataFrame:
    """The rows that came too late, with the batch they came in."""
    return spark.table(tables.arrivals).where("late").drop("late")
