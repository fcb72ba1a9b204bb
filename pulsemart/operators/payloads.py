"""Payloads of any shape: parsed once into VARIANT, saved, and read by path with a schema.

A topic whose payload is not known beforehand needs no schema to be kept. The schema is a
parameter of each reader, and `discover` tells what has landed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemart.functions.columns import as_text
from pulsemart.operators.topics import Topic


def parse_once(messages: DataFrame) -> DataFrame:
    """Messages with `body`, their payload as VARIANT, in place of the bytes; batch or stream.

    A payload that is not JSON, or no payload, gives NULL; a JSON null, number or list is kept.
    """
    body = F.try_parse_json(as_text("value")).alias("body")
    return messages.select(*(c for c in messages.columns if c != "value"), body)


def path_of(name: str) -> str:
    """The path of a payload's field of that name. Paths have no escapes, so a name with both
    kinds of quotes has none; it cannot be read by path."""
    if "'" in name and '"' in name:
        raise ValueError(f"no path names a field with both kinds of quotes: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def at(path: str, kind: str, body: str = "body") -> Column:
    """What stands at a path, as a type; NULL where nothing does or where it has no such value."""
    return F.try_variant_get(body, path, kind)


def fields(
    parsed: DataFrame, schema: str, paths: Mapping[str, str] | None = None, body: str = "body"
) -> list[Column]:
    """The columns of a DDL schema, each from the field of its name or from its path.

    Over a saved table each is read by the scan itself, without the rest of the payload.
    """
    paths = paths or {}
    return [
        at(paths.get(f.name, path_of(f.name)), f.dataType.simpleString(), body).alias(f.name)
        for f in T.DataType.fromDDL(schema).fields
    ]


def topic_rows(parsed: DataFrame, topic: Topic) -> DataFrame:
    """The payload columns of one topic, as `split_topic` gives them, from parsed messages."""
    wanted = fields(parsed, topic.payload_schema, topic.paths)
    return parsed.where(F.col("topic") == topic.name).select(*wanted)


def discover(parsed: DataFrame) -> DataFrame:
    """Per topic: messages, those whose payload is no JSON, and the schema of the others.

    The schema combines those of all payloads, so a field that is a number here and text there
    is a VARIANT in it. Partial schemas are combined before they are shuffled.
    """
    return parsed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("body").isNull()).alias("unparsed"),
        F.schema_of_variant_agg("body").alias("schema"),
    )


def field_counts(parsed: DataFrame, topic: Topic) -> DataFrame:
    """How well a schema fits a topic: per column the rows with a value, and with another type.

    `other` counts payloads that have something at the path which is no value of that type.
    """
    schema = T.DataType.fromDDL(topic.payload_schema)
    rows = parsed.where(F.col("topic") == topic.name)
    counts = []
    for i, f in enumerate(schema.fields):
        path = topic.paths.get(f.name, path_of(f.name))
        typed = at(path, f.dataType.simpleString())
        there = at(path, "variant")
        some = there.isNotNull() & ~F.coalesce(F.is_variant_null(there), F.lit(False))
        counts += [
            F.count(typed).alias(f"values_{i}"),
            F.count_if(some & typed.isNull()).alias(f"other_{i}"),
        ]
    one = rows.agg(F.count(F.lit(1)).alias("rows"), *counts)
    parts = [
        F.struct(
            F.lit(f.name).alias("field"),
            F.col("rows"),
            F.col(f"values_{i}").alias("values"),
            F.col(f"other_{i}").alias("other"),
        )
        for i, f in enumerate(schema.fields)
    ]
    return one.select(F.inline(F.array(*parts)))
