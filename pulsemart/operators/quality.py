"""Quality rules with counts, and the checks made before trusting a feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulsemart.constants import FIRST_PRODUCTION_DEVICE


def passes(condition: str) -> Column:
    """Whether a row meets a SQL condition; a NULL result counts as a failure."""
    return F.coalesce(F.expr(condition), F.lit(False))


def all_pass(rules: Mapping[str, str]) -> Column:
    return reduce(and_, (passes(c) for c in rules.values()), F.lit(True))


def keeps(rules: Mapping[str, str]) -> Column:
    """`all_pass` for use as a filter.

    A filter drops a row on NULL anyway. Left bare, the conditions can reach the scan.
    """
    return reduce(and_, (F.expr(c) for c in rules.values()), F.lit(True))


def rule_counts(rules: Mapping[str, str]) -> list[Column]:
    """Aggregates: rows seen, rows that fail each rule, rows that fail any."""
    return [
        F.count(F.lit(1)).alias("rows_checked"),
        *(F.count_if(~passes(c)).alias(f"failed_{name}") for name, c in rules.items()),
        F.count_if(~all_pass(rules)).alias("rows_dropped"),
    ]


def enforce(
    df: DataFrame, rules: Mapping[str, str], observation: Observation | str | None = None
) -> DataFrame:
    """Keep the rows that pass every rule; `observation` receives the counts as rows flow by."""
    if observation is not None:
        df = df.observe(observation, *rule_counts(rules))
    return df.where(keeps(rules))


def quality_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The same counts as one row, computed as a query of its own."""
    return df.agg(*rule_counts(rules))


def message_report(messages: DataFrame) -> DataFrame:
    """Per topic: messages landed, and those whose payload could not be decoded."""
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("value").isNull()).alias("undecodable"),
    )


def distinct_topics(messages: DataFrame) -> DataFrame:
    return messages.select("topic").distinct()


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .where("count > 1")
        .orderBy(F.col("count").desc(), *keys)
    )


def test_devices(df: DataFrame, first_production: int = FIRST_PRODUCTION_DEVICE) -> DataFrame:
    """Rows from devices below the production range."""
    return df.where(F.col("device_id") < first_production)


def key_check(child: DataFrame, parent: DataFrame, key: str, label: str) -> DataFrame:
    """One row on how a declared key holds: matched, orphaned and duplicated.

    Both sides are counted per key first. The join then meets one row per key, whatever
    the number of rows behind it.
    """
    children = child.groupBy(key).agg(F.count(F.lit(1)).alias("children"))
    parents = parent.groupBy(key).agg(F.count(F.lit(1)).alias("parents"))
    both = children.join(parents, key, "full_outer")
    n, p = F.coalesce("children", F.lit(0)), F.coalesce("parents", F.lit(0))
    return both.agg(
        F.coalesce(F.sum(F.when(p > 0, n)), F.lit(0)).cast("long").alias("matched_rows"),
        F.coalesce(F.sum(F.when(p == 0, n)), F.lit(0)).cast("long").alias("orphan_rows"),
        F.count_if(p > 1).alias("duplicated_parent_keys"),
        F.count_if((n == 0) & (p > 0)).alias("unused_parent_keys"),
    ).select(F.lit(label).alias("relation"), "*")
