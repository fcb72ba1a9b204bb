"""The sales dashboard: its datasets, its widgets under filters, and a page in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.constants import GOAL_PERIOD, SALES_GOAL
from pulsemart.functions.columns import mean, month_start, total
from pulsemart.operators import filters as flt
from pulsemart.operators import metrics
from pulsemart.session import scratch_path

ORDER_HISTORY = "orderhistory"
GOAL = "SumTotalSales"
MAIN_PAGE = "Visualizations"
BROWSE_PAGE = "Browse data"
STATES = "Revenue Share by State"
HEATMAP = "Distribution of Order Quantity across States and Sales Reps"


@dataclass(frozen=True)
class Widget:
    """A figure on a page: the dataset it reads and what it computes from it."""

    dataset: str
    page: str
    compute: Callable[[DataFrame], DataFrame]


def sales_widgets(
    decimals: int | None = None,
    goal: int = SALES_GOAL,
    period: tuple[str, str] = GOAL_PERIOD,
) -> dict[str, Widget]:
    """The widgets of the two pages, by title."""
    return {
        "Sales Goal": Widget(
            GOAL, MAIN_PAGE, lambda o: metrics.sales_vs_goal(o, goal, *period, decimals)
        ),
        "Order History": Widget(
            ORDER_HISTORY, MAIN_PAGE, lambda h: metrics.monthly_orders(h, decimals)
        ),
        "Average Order Amount per Product": Widget(
            ORDER_HISTORY, MAIN_PAGE, lambda h: metrics.amount_by_product(h, decimals=decimals)
        ),
        STATES: Widget(
            ORDER_HISTORY, MAIN_PAGE, lambda h: metrics.share_by_state(h, decimals=decimals)
        ),
        HEATMAP: Widget(ORDER_HISTORY, MAIN_PAGE, metrics.quantity_by_rep_state),
        "Browse": Widget(ORDER_HISTORY, BROWSE_PAGE, lambda h: metrics.browse(h, "orderdate")),
    }


@dataclass(frozen=True)
class Dashboard:
    """Datasets by name, with the filters its viewer has set.

    The goal counter reads its own dataset, so no order-history filter changes it.
    """

    datasets: Mapping[str, DataFrame]
    filters: tuple[flt.Filter, ...] = ()
    widgets: Mapping[str, Widget] = field(default_factory=sales_widgets)

    def filtered(self, *more: flt.Filter) -> Dashboard:
        return Dashboard(self.datasets, (*self.filters, *more), self.widgets)

    def without(self, *gone: flt.Filter) -> Dashboard:
        kept = tuple(f for f in self.filters if not any(f is g for g in gone))
        return Dashboard(self.datasets, kept, self.widgets)

    def show(self, name: str) -> DataFrame:
        """One widget under the filters that reach it."""
        widget = self.widgets[name]
        rows = flt.apply(
            self.datasets[widget.dataset], self.filters, widget.dataset, widget.page, name
        )
        return widget.compute(rows)


def page_in_one_pass(
    history: DataFrame,
    filters: Iterable[flt.Filter] = (),
    page: str = MAIN_PAGE,
    decimals: int | None = None,
    with_share: bool = False,
) -> DataFrame:
    """All order-history charts of a page from one scan, one join and one shuffle.

    Every row is a bar, slice or cell: the chart, its one or two labels and all measures.
    The separate widgets would each join the orders again. A clicked mark filters every chart but
    its own: conditions that reach all charts act on the rows, the others decide per chart which
    rows its measures count. `with_share` adds each state's part of the revenue; it is NULL for
    the other charts. The whole is one more grouping set of the same pass; the charts' rows, one
    per bar, slice or cell, are saved, and the row of the whole is joined to those of the states.
    """
    charts = {
        "Order History": ["order_month"],
        "Average Order Amount per Product": ["productname"],
        STATES: ["customer_state"],
        HEATMAP: ["salesrep", "customer_state"],
    }
    dims = ["order_month", "productname", "salesrep", "customer_state"]
    filters = tuple(filters)
    clicks = tuple(f for f in filters if f.source in charts)
    reached = {
        name: tuple(
            i
            for i, f in enumerate(clicks)
            if f.source != name and f.page in (None, page) and f.dataset == ORDER_HISTORY
        )
        for name in charts
    }
    rows = flt.apply(
        history, [f for f in filters if f.source not in charts], ORDER_HISTORY, page
    ).withColumn("order_month", month_start("orderdate"))
    # Charts that the same clicks reach share their measures.
    kinds = list(dict.fromkeys(reached.values()))
    counted = [
        reduce(and_, (clicks[i].condition for i in kind), F.lit(True)).eqNullSafe(True)
        for kind in kinds
    ]
    # Rows that no chart counts need not be spread over the charts.
    rows = rows.where(reduce(or_, counted)) if all(kinds) else rows
    rows = rows.withColumns({f"in_{k}": c for k, c in enumerate(counted)})

    def set_id(shown: list[str]) -> int:
        # A grouping id has one bit per dimension, first dimension highest, 1 = left out.
        return sum(1 << i for i, d in enumerate(reversed(dims)) if d not in shown)

    def per_chart(value: Callable[[str], Column | None]) -> Column:
        out = F.lit(None)
        for name, shown in charts.items():
            if (own := value(name)) is not None:
                out = F.when(F.col("set_id") == set_id(shown), own).otherwise(out)
        return out

    def label(position: int) -> Column:
        def of(name: str) -> Column | None:
            shown = charts[name]
            return F.col(shown[position]).cast("string") if position < len(shown) else None

        return per_chart(of)

    def measures(kind: int) -> list[Column]:
        def own(name: str) -> Column:
            return F.when(F.col(f"in_{kind}"), F.col(name))

        return [
            total(own("orderamt"), decimals).alias(f"amount_{kind}"),
            mean(own("orderamt"), decimals).alias(f"average_amount_{kind}"),
            F.sum(own("quantity")).alias(f"quantity_{kind}"),
            F.count_if(f"in_{kind}").alias(f"orders_{kind}"),
        ]

    def measure(name: str) -> Column:
        return per_chart(lambda chart: F.col(f"{name}_{kinds.index(reached[chart])}")).alias(name)

    sets = [[F.col(d) for d in names] for names in charts.values()]
    state_kind = kinds.index(reached[STATES])
    is_whole = F.col("set_id") == set_id([])
    shown = (
        rows.groupingSets([*sets, []] if with_share else sets, *dims)
        .agg(
            F.grouping_id().alias("set_id"),
            *(m for kind in range(len(kinds)) for m in measures(kind)),
        )
        .select(
            per_chart(F.lit).alias("chart"),
            label(0).alias("label"),
            label(1).alias("second_label"),
            *(measure(n) for n in ("amount", "average_amount", "quantity", "orders")),
            *(
                [
                    F.when(is_whole, F.lit(STATES)).alias("whole_of"),
                    F.when(is_whole, F.col(f"amount_{state_kind}")).alias("whole"),
                ]
                if with_share
                else []
            ),
        )
    )
    if with_share:
        # Saved, so that its two readers do not compute the page twice.
        path = scratch_path(history.sparkSession, "page")
        shown.write.parquet(path)
        saved = history.sparkSession.read.schema(shown.schema).parquet(path)
        shown = saved.where("chart IS NOT NULL").drop("whole_of", "whole")
        whole = saved.where("whole_of IS NOT NULL").select("whole_of", "whole")
    if any(kinds):
        shown = shown.where(F.col("orders") > 0)
    if with_share:
        part = F.col("amount").cast("double") / F.col("whole").cast("double")
        shown = (
            shown.join(F.broadcast(whole), shown["chart"] == whole["whole_of"], "left")  # one row
            .withColumn("share", part)
            .drop("whole_of", "whole")
        )
    return shown
