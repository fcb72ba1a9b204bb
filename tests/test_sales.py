"""Joins, figures, filters and questions on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemart.functions.columns import total
from pulsemart.operators import filters as flt
from pulsemart.operators import metrics, questions, star
from pulsemart.plans import dashboard
from pulsemart.session import scratch_table
from pulsemart.sinks import tables as sink

D = dt.date


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [
            (1, "c1", "p1", D(2024, 1, 1), 2, 100, "Ann"),
            (2, "c1", "p2", D(2024, 1, 31), 1, 50, "Bob"),
            (3, "c2", "p1", D(2024, 12, 31), 4, 200, "Ann"),
            (4, "c3", "p3", D(2023, 12, 31), 5, 10, "Bob"),
            (5, "gone", "p1", D(2024, 5, 5), 6, 999, "Ann"),
            (6, "c1", None, D(2024, 5, 6), 7, 999, "Ann"),
        ],
        "orderid INT, customerid STRING, productid STRING, orderdate DATE, quantity INT, "
        "orderamt INT, salesrep STRING",
    ).withColumn("orderamt", F.col("orderamt").cast("decimal(18,2)"))


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [("c1", "One", "Sydney", "NSW"), ("c2", "Two", "Perth", "WA"), ("c3", "Three", "Hobart", None)],
        "customerid STRING, customername STRING, city STRING, state STRING",
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(
        [("p1", "bike"), ("p2", "bell"), ("p3", "bike")], "productid STRING, productname STRING"
    )


@pytest.fixture(scope="module")
def history(orders, customers, products):
    return star.order_history(orders, customers, products)


def test_history_holds_all_order_columns_then_names(orders, customers, products, history):
    assert history.columns == [*orders.columns, "customername", "customer_state", "productname"]
    assert sorted(r.orderid for r in history.collect()) == [1, 2, 3, 4]
    with_city = star.order_history(orders, customers, products, include_city=True)
    assert with_city.where("orderid = 3").first().city == "Perth"


def test_exact_sums_equal_plain_ones(history, orders):
    for decimals in (None, 0, 2, 4):
        assert metrics.sales_vs_goal(orders, decimals=decimals).first().Total_Sales == 2348
        shares = {r.state: r.share for r in metrics.share_by_state(history, decimals=decimals).collect()}
        assert shares["WA"] == pytest.approx(200 / 360)


def test_exact_sums_do_not_depend_on_the_order_of_rows(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9, 0.05, 12.34] * 50
    for values in (amounts, sorted(amounts), sorted(amounts, reverse=True)):
        df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").coalesce(1)
        assert df.select(total("x", 2)).first()[0] == 649.5


def test_goal(orders):
    reached = metrics.sales_vs_goal(orders, goal=2348).first()
    assert (reached.Total_Sales, reached.Sales_Goal, reached.at_or_below_goal) == (2348, 2348, True)
    assert metrics.sales_vs_goal(orders, goal=2347).first().at_or_below_goal is False
    nothing = metrics.sales_vs_goal(orders, first="1990-01-01", last="1990-12-31").first()
    assert nothing.Total_Sales is None
    assert metrics.sales_vs_goal(orders).first().Sales_Goal == 390000000


def test_products_of_one_name(history):
    by_name = {r[0]: r[1] for r in metrics.amount_by_product(history).collect()}
    assert by_name == {"bike": pytest.approx(310 / 3), "bell": 50.0}
    by_id = metrics.amount_by_product(history, "sum", by_id=True).collect()
    assert sorted((r.productid, int(r.order_amount)) for r in by_id) == [
        ("p1", 300),
        ("p2", 50),
        ("p3", 10),
    ]


def test_shares_add_up_to_one_with_a_null_state(history):
    for measure in ("revenue", "orders"):
        shares = metrics.share_by_state(history, measure).collect()
        assert {r.state for r in shares} == {"NSW", "WA", None}
        assert sum(r.share for r in shares) == pytest.approx(1.0)


def test_browse_sorts_both_ways_and_hides_keys(history):
    up = metrics.browse(history, "orderamt")
    assert not {"orderid", "customerid", "productid"} & set(up.columns)
    amounts = [r.orderamt for r in up.collect()]
    assert amounts == sorted(amounts)
    down = [r.orderamt for r in metrics.browse(history, "orderamt", descending=True).collect()]
    assert down == amounts[::-1]


@pytest.fixture
def page(history, orders):
    return dashboard.Dashboard({dashboard.ORDER_HISTORY: history, dashboard.GOAL: orders})


def filter_on(condition, **scope):
    return flt.Filter(dashboard.ORDER_HISTORY, condition, **scope)


def months(page):
    return sorted(r.order_month for r in page.show("Order History").collect())


def test_no_choice_means_all_rows(page):
    open_ended = filter_on(flt.date_range("orderdate")), filter_on(flt.any_of("productid", []))
    assert months(page.filtered(*open_ended)) == months(page)
    since = filter_on(flt.date_range("orderdate", first="2024-12-31"))
    assert months(page.filtered(since)) == [D(2024, 12, 1)]


def test_local_filter_stays_on_its_page_and_global_does_not(page):
    local = filter_on(flt.date_range("orderdate", "2024-01-01", "2024-01-31"), page=dashboard.MAIN_PAGE)
    everywhere = filter_on(flt.any_of("productid", ["p1"]))
    both = page.filtered(local, everywhere)
    assert months(both) == [D(2024, 1, 1)]
    assert both.show("Browse").count() == 2
    assert both.show("Sales Goal").collect() == page.show("Sales Goal").collect()


def test_filters_split_the_total(page):
    def total(p):
        return sum(r.total_sales_value for r in p.show("Order History").collect())

    parts = [page.filtered(filter_on(flt.any_of("productid", [p]))) for p in ("p1", "p2", "p3")]
    assert sum(total(p) for p in parts) == total(page)


def test_clicked_mark_filters_the_others_and_can_be_undone(page):
    heatmap = dashboard.HEATMAP
    mark = filter_on(
        flt.clicked({"salesrep": "Bob", "customer_state": None}),
        page=dashboard.MAIN_PAGE,
        source=heatmap,
    )
    clicked = page.filtered(mark)
    assert months(clicked) == [D(2023, 12, 1)]
    assert clicked.show(heatmap).count() == page.show(heatmap).count()
    assert months(clicked.without(mark)) == months(page)


def test_one_pass_page_equals_its_widgets(page, history):
    only = filter_on(flt.date_range("orderdate", "2024-01-01"))
    shown = page.filtered(only)
    cells = dashboard.page_in_one_pass(history, [only]).collect()

    def column(chart, measure):
        return sorted(
            ((c.label, c.second_label, float(c[measure])) for c in cells if c.chart == chart),
            key=str,
        )

    def of_widget(chart, labels, measure):
        return sorted(
            (
                (*[None if r[x] is None else str(r[x]) for x in labels], None)[:2] + (float(r[measure]),)
                for r in shown.show(chart).collect()
            ),
            key=str,
        )

    for chart, labels, measure, named in [
        ("Order History", ["order_month"], "total_sales_value", "amount"),
        ("Order History", ["order_month"], "count_of_sales_orders", "orders"),
        ("Average Order Amount per Product", ["productname"], "average_order_amount", "average_amount"),
        ("Revenue Share by State", ["state"], "revenue", "amount"),
        (
            "Distribution of Order Quantity across States and Sales Reps",
            ["rep", "state"],
            "qty",
            "quantity",
        ),
    ]:
        assert column(chart, named) == of_widget(chart, labels, measure), chart


@pytest.mark.parametrize(
    ("spoken", "code"),
    [("NSW", "NSW"), (" wa ", "WA"), ("Victoria", "VIC"), ("western australia", "WA"), ("Washington", None)],
)
def test_spoken_state(spoken, code):
    assert questions.state_code(spoken) == code


def test_questions(orders, customers):
    assert questions.customers_in_state(customers, "New South Wales").first().customers == 1
    assert questions.customers_in_state(customers, "Washington").first().customers == 0
    assert questions.list_customers_in_state(customers, "Washington").isEmpty()
    listed = questions.list_customers_in_state(customers, "WA").collect()
    assert [r.customername for r in listed] == ["Two"]
    reps = questions.revenue_by_rep_in_state(orders, customers, "NSW").collect()
    assert {(r.salesrep, int(r.revenue)) for r in reps} == {("Ann", 1099), ("Bob", 50)}
    assert questions.top_rep_in_state(orders, customers, "NSW").first().salesrep == "Ann"


def test_top_rep_tie_goes_to_the_first_name(spark, customers):
    tied = spark.createDataFrame(
        [("c1", "Zed", 5), ("c1", "Amy", 5)], "customerid STRING, salesrep STRING, orderamt INT"
    )
    assert questions.top_rep_in_state(tied, customers, "NSW").first().salesrep == "Amy"


def test_refresh_may_read_the_table_it_replaces(spark):
    name = scratch_table(spark, "numbers")
    sink.refresh(spark, name, lambda: spark.range(3).toDF("n"))
    doubled = sink.refresh(spark, name, lambda: spark.table(name).select((F.col("n") * 2).alias("n")))
    assert sorted(r.n for r in doubled.collect()) == [0, 2, 4]


def test_failed_refresh_leaves_the_old_rows(spark):
    name = scratch_table(spark, "numbers")
    sink.refresh(spark, name, lambda: spark.range(3).toDF("n"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sink.refresh(spark, name, lambda: spark.range(1).select((1 / F.col("id")).alias("n")))
    assert spark.table(name).count() == 3


def test_copy_replaces_the_target(spark):
    there, here = scratch_table(spark, "there"), scratch_table(spark, "here")
    sink.save(spark.range(3), there)
    sink.save(spark.range(9), here)
    assert sink.copy_table(spark, there, here).count() == 3
    assert sink.save(spark.range(2), here, "append").count() == 5


def test_one_pass_page_under_clicked_marks(page, history):
    """Each chart keeps its own marks out and heeds those of the others, alone and together."""
    named = history.withColumn("order_month", F.date_trunc("month", "orderdate").cast("date"))
    cell = filter_on(
        flt.clicked({"salesrep": "Bob", "customer_state": None}),
        page=dashboard.MAIN_PAGE,
        source=dashboard.HEATMAP,
    )
    piece = filter_on(
        flt.clicked({"customer_state": "NY"}), page=dashboard.MAIN_PAGE, source="Revenue Share by State"
    )
    widgets = [
        ("Order History", "total_sales_value", "amount"),
        ("Average Order Amount per Product", "average_order_amount", "average_amount"),
        ("Revenue Share by State", "share", "share"),
        (dashboard.HEATMAP, "qty", "quantity"),
    ]
    for chosen in ([cell], [piece], [cell, piece], [filter_on(flt.date_range("orderdate", "2024-01-01")), cell]):
        cells = dashboard.page_in_one_pass(named, chosen, with_share=True).collect()
        for chart, measure, ours in widgets:
            want = sorted(float(r[measure]) for r in page.filtered(*chosen).show(chart).collect())
            got = sorted(float(c[ours]) for c in cells if c.chart == chart)
            assert got == pytest.approx(want), (chart, len(chosen))
