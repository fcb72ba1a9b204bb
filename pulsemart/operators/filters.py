"""Dashboard filters: what they test, and which widgets they reach."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.functions.columns import in_days


@dataclass(frozen=True)
class Filter:
    """A condition on one dataset.

    With `page` it is local to that page; without, it is global. `source` names the widget
    whose mark was clicked: that widget itself stays as it is.
    """

    dataset: str
    condition: Column
    page: str | None = None
    source: str | None = None


def date_range(
    column: str, first: dt.date | str | None = None, last: dt.date | str | None = None
) -> Column:
    """Days from `first` to `last`, both included; no bounds means all rows."""
    return in_days(column, first, last)


def any_of(column: str, values: Iterable[Any]) -> Column:
    """One of several chosen values; nothing chosen means all rows."""
    chosen = list(values)
    return F.col(column).isin(chosen) if chosen else F.lit(True)


def clicked(mark: Mapping[str, Any]) -> Column:
    """Equality on every dimension of a clicked mark; a mark may stand for NULL."""
    return reduce(and_, (F.col(c).eqNullSafe(F.lit(v)) for c, v in mark.items()), F.lit(True))


def applicable(
    filters: Iterable[Filter], dataset: str, page: str, widget: str | None = None
) -> list[Column]:
    """The conditions that reach a widget of `dataset` on `page`."""
    return [
        f.condition
        for f in filters
        if f.dataset == dataset
        and f.page in (None, page)
        and (f.source is None or f.source != widget)
    ]


def apply(
    df: DataFrame, filters: Iterable[Filter], dataset: str, page: str, widget: str | None = None
) -> DataFrame:
    return reduce(DataFrame.where, applicable(filters, dataset, page, widget), df)
