"""Streaming steps: ingest, split by topic, clean, average. Each is a DataFrame to DataFrame."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.constants import WATERMARK_DELAY
from pulsemart.operators.cleaning import collapse_copies, shape
from pulsemart.operators.quality import enforce, passes
from pulsemart.operators.topics import Topic
from pulsemart.sources.files import message_columns, stream_messages, with_lineage

#: Over how many groups rows without any key are dealt before one of them is kept.
NO_KEY_GROUPS = 64

RULE_POSITIONS = ("after", "before", "at_watermark")


def bronze(
    spark: SparkSession, path: str, files_per_batch: int | None = None, lineage: bool = False
) -> DataFrame:
    """Messages as they land, with the file of each if wanted. The observed count is of rows read,
    before any filter."""
    read = stream_messages(spark, path, files_per_batch=files_per_batch)
    landed = with_lineage(message_columns(read)) if lineage else message_columns(read)
    return landed.observe("ingested", F.count(F.lit(1)).alias("rows"))


def refuses_no_keys(rows: DataFrame, topic: Topic) -> bool:
    """Whether a rule on the keys alone turns away rows whose keys are all NULL."""
    nulls = rows.sparkSession.range(1).select(
        *(F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in topic.keys)
    )
    for condition in topic.rules.values():
        try:
            if not nulls.select(passes(condition)).first()[0]:
                return True
        except AnalysisException:
            continue  # it needs other columns as well
    return False


def silver(
    parsed: DataFrame,
    topic: Topic,
    delay: str = WATERMARK_DELAY,
    rule_position: str = "after",
    collapse: bool = False,
) -> DataFrame:
    """Shaped rows, one per key within the watermark, that pass the topic's rules.

    Where the rules act decides which rows move the watermark:

    * ``after``: all rows do, and dropped rows are counted once per key;
    * ``before``: only rows that pass do;
    * ``at_watermark``: all rows do, but failing rows take no state and are counted with
      the duplicates that `collapse` left. Only for rules on the keys. The observed count is
      what keeps Spark from moving the filter below the watermark.

    A topic without event time is de-duplicated without a watermark and its state grows.
    `collapse` thins out copies before the shuffle, at the price of a pass through Python; worth it
    only where copies abound.

    Rows whose keys are all NULL, as those of payloads that do not parse, would all meet in one
    task. Where a rule refuses them anyway they are counted as `unparsed` and dropped before the
    shuffle. Otherwise one stays, as in batch: they are first thinned to one for each of
    NO_KEY_GROUPS, which takes a shuffle and a state more; `unparsed` then counts the rows in
    which all columns are NULL.
    """
    if rule_position not in RULE_POSITIONS:
        raise ValueError(f"rule_position must be one of {RULE_POSITIONS}, not {rule_position!r}")
    keys = list(topic.keys)
    rows = shape(parsed, topic)
    if rule_position == "before" and topic.rules:
        rows = enforce(rows, topic.rules, "quality")
    no_keys = reduce(and_, (F.col(k).isNull() for k in keys))
    refused = refuses_no_keys(rows, topic)
    nothing = no_keys if refused else reduce(and_, (F.col(c).isNull() for c in rows.columns))
    rows = rows.observe("unparsed", F.count_if(nothing).alias("rows"))
    if refused:
        rows = rows.where(~no_keys)
    if collapse:
        rows = collapse_copies(rows, keys)
    if topic.time_column is not None:
        rows = rows.withWatermark("timestamp", delay)
    if rule_position == "at_watermark" and topic.rules:
        rows = enforce(rows, topic.rules, "quality")
    if not refused:
        group = F.floor(F.rand() * NO_KEY_GROUPS)
        rows = rows.withColumn("__group", F.when(no_keys, group))
        rows = rows.dropDuplicates([*keys, "__group"]).drop("__group")
    rows = rows.dropDuplicates(keys)
    if rule_position == "after" and topic.rules:
        rows = enforce(rows, topic.rules, "quality")
    return rows
