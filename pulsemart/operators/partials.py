"""Aggregates in parts: sums and counts of some rows that can be combined with those of others."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a figure's parts are made of rows, and how they are combined.
KINDS = {
    "count": (F.count, F.sum),
    "sum": (F.sum, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


@dataclass(frozen=True)
class Figures:
    """Groups by `keys`, with figures as name to (kind, SQL expression); kinds are those of KINDS.

    An average is a sum and a count, divided where it is shown. Sums of whole numbers are exact
    however rows are dealt to batches; sums of DOUBLE may differ in the last places.
    """

    keys: tuple[str, ...]
    parts: Mapping[str, tuple[str, str]]

    def of_rows(self, rows: DataFrame) -> DataFrame:
        made = [KINDS[kind][0](F.expr(e)).alias(name) for name, (kind, e) in self.parts.items()]
        return rows.groupBy(*self.keys).agg(*made)

    def combined(self, before: DataFrame | None, more: DataFrame) -> DataFrame:
        """Partial figures put together. The shuffle is of partial rows, one per group and task."""
        if before is None:
            return more
        both = before.unionByName(more)
        made: list[Column] = [
            KINDS[kind][1](name).alias(name) for name, (kind, _) in self.parts.items()
        ]
        return both.groupBy(*self.keys).agg(*made)
