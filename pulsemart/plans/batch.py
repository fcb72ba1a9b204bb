"""The batch run: raw messages to bronze, to one topic's rows, to cleaned rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from pulsemart.operators.cleaning import clean, split_topic
from pulsemart.operators.payloads import parse_once, topic_rows
from pulsemart.operators.topics import BPM, Topic
from pulsemart.sinks.tables import save
from pulsemart.sources.files import message_columns, read_messages


def bronze(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Save raw messages, one directory per topic so that a topic is read on its own."""
    saved = save(read_messages(spark, path), table, partition_by=["topic"])
    return message_columns(saved)


def run_topic(
    messages: DataFrame,
    topic: Topic,
    parsed_table: str,
    silver_table: str,
    silver_mode: str = "overwrite",
    order_by: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Save a topic's parsed rows, then its cleaned rows; `observation` gets the rule counts.

    The cleaning reads the saved rows: over the parsing expression Spark would push the
    rule filter down and parse every payload twice.
    """
    parsed = save(split_topic(messages, topic), parsed_table)
    return save(clean(parsed, topic, order_by, observation), silver_table, silver_mode)


def payloads(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Save raw messages with each payload parsed to VARIANT, one directory per topic."""
    return save(parse_once(read_messages(spark, path)), table, partition_by=["topic"])


def run_payload_topics(
    parsed: DataFrame,
    silver_tables: Mapping[Topic, str],
    silver_mode: str = "overwrite",
    order_by: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Save the cleaned rows of several topics out of one saved table of parsed payloads.

    No payload is parsed again: a topic's columns are read by path from its own directory.
    """
    return {
        topic.name: save(clean(topic_rows(parsed, topic), topic, order_by), name, silver_mode)
        for topic, name in silver_tables.items()
    }


def run(
    spark: SparkSession,
    path: str,
    bronze_table: str,
    parsed_table: str,
    silver_table: str,
    topic: Topic = BPM,
    silver_mode: str = "overwrite",
    order_by: Sequence[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """All three tables; returns the cleaned one."""
    messages = bronze(spark, path, bronze_table)
    return run_topic(
        messages, topic, parsed_table, silver_table, silver_mode, order_by, observation
    )
