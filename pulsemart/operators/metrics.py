"""Sales figures over the order history. Each returns one row per group shown.

`decimals` is the number of decimals that amounts have at most; see `functions.columns.total`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pulsemart.constants import GOAL_PERIOD, SALES_GOAL
from pulsemart.functions.columns import from_units, in_days, in_units, mean, month_start, total


def sales_vs_goal(
    orders: DataFrame,
    goal: int = SALES_GOAL,
    first: dt.date | str = GOAL_PERIOD[0],
    last: dt.date | str = GOAL_PERIOD[1],
    decimals: int | None = None,
) -> DataFrame:
    """Sales of a period beside its goal, and whether they are still at or below it."""
    return (
        orders.where(in_days("orderdate", first, last))
        .agg(total("orderamt", decimals).alias("Total_Sales"))
        .select("Total_Sales", F.lit(goal).alias("Sales_Goal"))
        .withColumn("at_or_below_goal", F.col("Total_Sales") <= F.col("Sales_Goal"))
    )


def monthly_orders(history: DataFrame, decimals: int | None = None) -> DataFrame:
    """Sales value and number of orders per month."""
    return history.groupBy(month_start("orderdate").alias("order_month")).agg(
        total("orderamt", decimals).alias("total_sales_value"),
        F.count(F.lit(1)).alias("count_of_sales_orders"),
    )


def amount_by_product(
    history: DataFrame,
    measure: str = "average",
    by_id: bool = False,
    decimals: int | None = None,
) -> DataFrame:
    """Average (or summed) order amount per product name.

    Names need not be unique; `by_id` keeps products of the same name apart.
    """
    keys = ["productid", "productname"] if by_id else ["productname"]
    measures = {
        "average": mean("orderamt", decimals).alias("average_order_amount"),
        "sum": total("orderamt", decimals).alias("order_amount"),
    }
    return history.groupBy(*keys).agg(measures[measure])


def share_by_state(
    history: DataFrame, measure: str = "revenue", decimals: int | None = None
) -> DataFrame:
    """Revenue (or number of orders) per state and its part of the whole.

    The grand total is taken over the per-state rows, so the one task that adds it up sees
    as many rows as there are states. A second aggregate for the total could make Spark
    join the orders twice.
    """
    measures = {
        "revenue": (F.sum(in_units("orderamt", decimals)), decimals),
        "orders": (F.count(F.lit(1)), None),
    }
    summed, places = measures[measure]
    by_state = history.groupBy(F.col("customer_state").alias("state")).agg(summed.alias("units"))
    shown = from_units("units", places)
    whole = from_units(F.sum("units").over(Window.partitionBy()), places)
    part = shown.cast("double") / whole.cast("double")
    return by_state.select("state", shown.alias(measure), part.alias("share"))


def quantity_by_rep_state(history: DataFrame) -> DataFrame:
    """Quantity ordered per sales rep and state, one row per cell."""
    return history.groupBy(
        F.col("salesrep").alias("rep"), F.col("customer_state").alias("state")
    ).agg(F.sum("quantity").alias("qty"))


def browse(
    history: DataFrame,
    sort_by: str,
    descending: bool = False,
    hidden: Sequence[str] = ("orderid", "customerid", "productid"),
) -> DataFrame:
    """The rows themselves without their keys, sorted on one column.

    Rows equal in that column are ordered by the rest, so a value that fills a third of
    the table still spreads over many sort partitions.
    """
    lead = F.col(sort_by).desc() if descending else F.col(sort_by).asc()
    rest = [c for c in history.columns if c != sort_by]
    return history.orderBy(lead, *rest).drop(*hidden)


@dataclass(frozen=True)
class Place:
    """Where a page of a browse table ends: its last row, and how many rows equal to it in every
    column have been shown."""

    row: Row
    shown: int


def browse_page(
    history: DataFrame,
    sort_by: str,
    size: int,
    after: Place | None = None,
    descending: bool = False,
) -> DataFrame:
    """The next `size` rows of `browse`, keys not yet hidden, in its order.

    Rows up to the last one shown are skipped by its values, so a page is a top-k over what
    follows and the whole is never sorted. On a saved history the scan skips too.
    """
    rest = [c for c in history.columns if c != sort_by]
    lead = F.col(sort_by).desc() if descending else F.col(sort_by).asc()
    ordered = [lead, *rest]
    if after is None:
        return history.orderBy(*ordered).limit(size)
    types = {f.name: f.dataType for f in history.schema.fields}

    def value(c: str) -> Column:
        return F.lit(after.row[c]).cast(types[c])

    here, known = F.col(sort_by), after.row[sort_by] is not None
    if not descending:  # NULL comes first
        beyond = here > value(sort_by) if known else here.isNotNull()
        skipped = here >= value(sort_by) if known else F.lit(True)
    else:  # NULL comes last
        beyond = (here < value(sort_by)) | here.isNull() if known else F.lit(False)
        skipped = (here <= value(sort_by)) | here.isNull() if known else here.isNull()
    at_place = F.struct(*(value(c).alias(c) for c in rest))
    tied = here.eqNullSafe(value(sort_by)) & (F.struct(*rest) >= at_place)
    return (
        history.where(skipped).where(beyond | tied).orderBy(*ordered).offset(after.shown).limit(size)
    )


def _alike(one: Row, other: Row) -> bool:
    """Equal in every column, with NaN equal to NaN as Spark has it."""
    return all(a == b or (a != a and b != b) for a, b in zip(one, other, strict=True))


def place_of(page: Sequence[Row], before: Place | None = None) -> Place | None:
    """The place after a page that has been read; None after an empty one."""
    if not page:
        return None
    same = sum(_alike(row, page[-1]) for row in page)
    went_on = before is not None and same == len(page) and _alike(before.row, page[-1])
    return Place(page[-1], same + (before.shown if went_on else 0))


def average_by(
    df: DataFrame, key: str, value: str, name: str, decimals: int | None = None
) -> DataFrame:
    """Average of a column per key, on a table or on a stream."""
    return df.groupBy(key).agg(mean(value, decimals).alias(name))


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
