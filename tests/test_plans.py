"""What the physical plans look like, and what a hot key does to them."""

import re

import pytest
from pyspark.sql import functions as F

from pulsemart import testdata
from pulsemart.checks.queries import QUERIES
from pulsemart.operators import cleaning, landing, metrics, quality, questions, sizes, star
from pulsemart.operators.topics import BPM
from pulsemart.plans import batch, dashboard
from pulsemart.session import scratch_path, scratch_table, shared_dir, size_for_input
from pulsemart.sinks import tables as sink
from pulsemart.sources import files as source

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution has run it."""
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    return executed.toString()


@pytest.fixture(scope="module")
def history(spark):
    return star.order_history(
        testdata.orders(spark, SF_DIR),
        testdata.customers(spark, SF_DIR),
        testdata.products(spark, SF_DIR),
    )


@pytest.fixture(scope="module")
def bronze(spark):
    return batch.bronze(spark, testdata.landed(spark, SF_DIR), scratch_table(spark, "bronze"))


SHARES = {"revenue_share_by_state", "order_share_by_state"}
BATCH = [
    name
    for name in QUERIES
    if not name.startswith("stream_") and name not in ("avg_bpm_stream", "landing_replay")
]


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_in_the_engine(spark, name):
    """No Python node, no cross join, no window or sort that gathers all rows in one task."""
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|MapIn(Arrow|Pandas)", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    if name in SHARES:
        # The grand total is taken over rows that are already one per state.
        assert re.search(
            r"Window.*\n.*Exchange SinglePartition.*\n(.*Project.*\n)?.*HashAggregate\(keys=\[", text
        )
    else:
        assert "Window" not in text


def test_one_topic_reads_one_directory_and_two_columns(bronze):
    text = plan(cleaning.split_topic(bronze, BPM))
    assert re.search(r"PartitionFilters: \[isnotnull\(topic#\d+\), \(topic#\d+ = bpm\)\]", text)
    assert "ReadSchema: struct<value:binary>" in text


def test_topic_filter_reaches_the_json_scan(spark):
    raw = source.read_messages(spark, testdata.landed(spark, SF_DIR))
    text = plan(cleaning.split_topic(raw, BPM))
    assert "EqualTo(topic,bpm)" in text
    assert text.count("from_json") == 1


def test_cleaning_filters_at_the_scan_and_shuffles_once(spark, bronze):
    name = scratch_table(spark, "parsed")
    cleaning.split_topic(bronze, BPM).write.saveAsTable(name)
    for order_by in (None, ["heartrate"]):
        text = plan(cleaning.clean(spark.table(name), BPM, order_by))
        assert "GreaterThanOrEqual(device_id,102000)" in text
        assert text.count("Exchange hashpartitioning") == 1
        assert "partial_" in text


def test_dates_reach_the_scan(spark, history):
    text = plan(metrics.sales_vs_goal(testdata.orders(spark, SF_DIR), first="1998-01-01", last="1998-12-31"))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in text
    assert "LessThan(o_orderdate,1999-01-01T00:00)" in text


def test_state_question_reaches_the_scan(spark):
    name = scratch_table(spark, "customers")
    testdata.customers(spark, SF_DIR).write.saveAsTable(name)
    text = plan(questions.customers_in_state(spark.table(name), "Victoria"))
    assert "EqualTo(state,VIC)" in text


def test_unread_columns_are_not_scanned(spark, history):
    text = plan(metrics.monthly_orders(history))
    assert "l_discount" not in text
    assert "c_name" not in text
    assert "p_name" not in text


def test_share_reads_the_orders_once(history):
    assert plan(metrics.share_by_state(history)).count("lineitem.parquet") == 1


def test_saved_dimensions_are_broadcast_by_size_only(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    name = scratch_table(spark, "people")
    people = sink.save(testdata.customers(spark, SF_DIR), name).where("state is not null")
    size = sizes.saved_bytes(people)
    assert size > 0
    hinted = sizes.broadcast_if_small(people, most=size)
    left_alone = sizes.broadcast_if_small(people, most=size - 1)
    orders = testdata.orders(spark, SF_DIR)
    on_customer = "BroadcastHashJoin [customerid"
    assert on_customer in plan(orders.join(hinted, "customerid"))
    assert on_customer not in plan(orders.join(left_alone, "customerid"))


def test_a_side_that_multiplies_rows_is_left_to_spark(spark):
    people = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    for side in [
        spark.range(10),
        people.crossJoin(spark.range(10_000_000)),
        people.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1_000_000)))),
        people.union(people),
        testdata.customers(spark, SF_DIR),
    ]:
        assert sizes.saved_bytes(side) is None
        assert sizes.broadcast_if_small(side) is side


def test_page_is_one_pass(history):
    text = plan(dashboard.page_in_one_pass(history))
    assert text.count("lineitem.parquet") == 1
    assert "Expand" in text


def test_batches_are_sorted_over_all_tasks(spark):
    raw = source.read_messages(spark, testdata.landed(spark, SF_DIR))
    text = plan(landing.next_batch(raw))
    assert "Limit" not in text and "TakeOrdered" not in text
    assert "SinglePartition" not in text


def test_both_ends_of_a_batch_reach_the_scan(spark):
    name = scratch_table(spark, "feed")
    testdata.messages(spark, SF_DIR).write.saveAsTable(name)
    feed = spark.table(name)
    mark = landing.high_water_mark(landing.next_batch(feed, n=5)).first()
    text = plan(landing.next_batch(feed, mark, 5))
    assert "GreaterThanOrEqual(timestamp," in text
    assert "LessThanOrEqual(timestamp," in text


def test_inventory_does_not_read_contents(spark):
    text = plan(source.list_files(spark, testdata.landed(spark, SF_DIR)))
    assert "content" not in text.split("ReadSchema")[1]


@pytest.fixture
def shuffled_joins(conf):
    """Dimensions too big to broadcast, and thresholds to match small test data."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.shuffle.partitions", "16")


@pytest.fixture
def skewed(spark):
    """Orders of which a third belong to one customer and one product."""
    hot = F.col("id") % 3 == 0
    orders = spark.range(0, 300_000, numPartitions=8).select(
        F.col("id").alias("orderid"),
        F.when(hot, 0).otherwise(F.col("id") % 997).alias("customerid"),
        F.when(hot, 0).otherwise(F.col("id") % 1009).alias("productid"),
        F.expr("date_add(date'2024-01-01', CAST(id % 366 AS INT))").alias("orderdate"),
        F.lit(1).alias("quantity"),
        F.lit(1).cast("decimal(18,2)").alias("orderamt"),
        F.concat(F.lit("rep"), F.col("id") % 7).alias("salesrep"),
    )
    customers = spark.range(1000).select(
        F.col("id").alias("customerid"),
        F.concat(F.lit("c"), "id").alias("customername"),
        F.concat(F.lit("s"), F.col("id") % 8).alias("state"),
    )
    products = spark.range(1010).select(
        F.col("id").alias("productid"), F.concat(F.lit("p"), "id").alias("productname")
    )
    return orders, customers, products


def test_hot_customer_is_split_and_no_order_is_lost(shuffled_joins, skewed):
    history = star.order_history(*skewed)
    text = final_plan(history)
    assert "skewed" in text or "skew=true" in text
    assert history.count() == 300_000


def test_hot_product_is_split_even_before_a_grouping_on_it(shuffled_joins, skewed):
    orders, _, products = skewed
    joined = orders.join(products, "productid").select(
        "productid", "productname", "orderamt", "salesrep"
    )
    by_id = metrics.amount_by_product(joined, "sum", by_id=True)
    text = final_plan(by_id)
    assert "skewed" in text or "skew=true" in text
    totals = by_id.agg(F.sum("order_amount"), F.max("order_amount")).first()
    assert totals[0] == 300_000
    assert totals[1] > 100_000


def test_hot_group_shrinks_before_the_shuffle(spark, skewed):
    """Counting, finding duplicates and de-duplicating all combine on the map side."""
    orders, customers, _ = skewed
    for df in (
        quality.find_duplicates(orders, ["customerid"]),
        cleaning.deduplicate(orders.select("customerid", "orderid"), ["customerid"]),
        cleaning.deduplicate(orders.select("customerid", "orderid"), ["customerid"], ["orderid"]),
        quality.key_check(orders, customers, "customerid", "x"),
    ):
        assert "partial_" in plan(df)


def test_shuffles_are_sized_by_the_input(spark, conf):
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert size_for_input(spark, 1) == (spark.sparkContext.defaultParallelism, 128 << 20)
    assert size_for_input(spark, 1 << 40) == (4096, 128 << 20)
    assert size_for_input(spark, 100 << 40) == (50_000, 1 << 30)


def test_side_files_go_to_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "x").startswith(named)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
