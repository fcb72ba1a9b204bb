"""A saved result that is brought up to date batch by batch, without a gap for its readers.

The name is a view of the newest version. A version is complete under a name of its own before the
view is replaced, one step in the catalog that also records the number of the batch it includes. A
batch that comes again, because a run was lost between its rows and its checkpoint, is known by its
number and changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsemart.sinks.tables import drop, save

#: The view's properties: the table it shows, the one before it, and the last batch in it.
VERSION, BEFORE, BATCH = "pulsemart.version", "pulsemart.before", "pulsemart.batch"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if VERSION not in found:
        raise ValueError(f"{name} is no view of versions")
    return found


def last_batch(spark: SparkSession, name: str) -> int | None:
    """The number of the last batch included, None before the first."""
    batch = _properties(spark, name).get(BATCH)
    return None if batch is None else int(batch)


def current(spark: SparkSession, name: str) -> DataFrame | None:
    """The newest version, None before the first."""
    table = _properties(spark, name).get(VERSION)
    return None if table is None else spark.table(table)


def bring_up_to(
    spark: SparkSession,
    name: str,
    batch: int,
    build: Callable[[DataFrame | None], DataFrame],
    show: str = "*",
) -> bool:
    """Include a batch: `build` makes the new version from the one before. False if it is in it.

    `show` is the view's select list. The version before stays until the next batch, for readers
    that have begun to read it; the one before that goes.
    """
    known = _properties(spark, name)
    if BATCH in known and int(known[BATCH]) >= batch:
        return False
    before = known.get(VERSION)
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    save(build(None if before is None else spark.table(before)), version)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}', "
        f"'{BEFORE}' = '{before or ''}', '{BATCH}' = '{batch}') AS SELECT {show} FROM {version}"
    )
    if known.get(BEFORE):
        drop(spark, known[BEFORE])
    return True
