"""The test tables read as sales tables and as a message feed (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.constants import FIRST_PRODUCTION_DEVICE
from pulsemart.functions.columns import as_bytes
from pulsemart.session import scratch_path

# The stand-ins that the SQL checks repeat.
GOAL_PERIOD = ("1998-01-01", "1998-12-31")
STATE_CODES = {"Nation Two": "NATION_2", "Nation Seven": "NATION_7"}
DEVICE_OFFSET = FIRST_PRODUCTION_DEVICE - 50
COPY_OFFSET = 1_000_000_000

# Amounts and readings in the test tables have two decimals.
DECIMALS = 2


# Stated here so that reading a table starts no job to look at its footers.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey LONG, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey LONG, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, "
    "props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per line item."""
    lines = table(spark, sf_dir, "lineitem")
    heads = table(spark, sf_dir, "orders")
    reps = table(spark, sf_dir, "supplier")
    return (
        lines.join(heads, lines.l_orderkey == heads.o_orderkey)
        .join(reps, lines.l_suppkey == reps.s_suppkey)
        .selectExpr(
            "l_orderkey AS orderid",
            "o_custkey AS customerid",
            "l_partkey AS productid",
            "CAST(o_orderdate AS DATE) AS orderdate",
            "l_quantity AS quantity",
            "l_extendedprice AS orderamt",
            "s_name AS salesrep",
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation")
    return people.join(places, people.c_nationkey == places.n_nationkey).selectExpr(
        "c_custkey AS customerid",
        "c_name AS customername",
        "c_mktsegment AS city",
        "n_name AS state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS productid", "p_name AS productname"
    )


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS opportunityid",
        "o_custkey AS customerid",
        "o_orderstatus AS salesphase",
        "o_orderpriority AS salesrep",
        "o_totalprice AS amount",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message, and every tenth a second time with an offset of its own."""
    second = F.unix_seconds(F.date_trunc("second", F.col("ts").cast("timestamp")))
    kind = F.col("event_type")
    topic = (
        F.when(kind.isin("click", "view", "error"), "bpm")
        .when(kind == "purchase", "workout")
        .otherwise("user_info")
    )
    payload = F.struct(
        (F.col("user_id") + DEVICE_OFFSET).cast("int").alias("device_id"),
        second.cast("double").alias("time"),
        F.col("value").alias("heartrate"),
    )
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return (
        table(spark, sf_dir, "events")
        .withColumn("copy", F.explode(copies))
        .select(
            as_bytes("user_id").alias("key"),
            as_bytes(F.to_json(payload)).alias("value"),
            topic.alias("topic"),
            F.lit(0).cast("long").alias("partition"),
            (F.col("event_id") + F.col("copy") * COPY_OFFSET).cast("long").alias("offset"),
            (second * 1000).alias("timestamp"),
        )
    )


def in_time_order(feed: DataFrame) -> DataFrame:
    """Partitioned so that each file written holds one stretch of time."""
    return feed.repartitionByRange("timestamp", "topic", "offset").sortWithinPartitions(
        "timestamp", "topic", "offset"
    )


#: Parts in which the feed arrives, and the delay that its late rows are held against.
ARRIVALS, ARRIVAL_DELAY = 4, "2 days"


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The feed in four parts of its time span, a third of the rows one part late."""
    feed = messages(spark, sf_dir)
    first, last = feed.agg(F.min("timestamp"), F.max("timestamp")).first()
    stretch = F.floor(ARRIVALS * (F.col("timestamp") - first) / (last - first + 1))
    part = F.least(stretch + (F.col("offset") % 3 == 0).cast("long"), F.lit(ARRIVALS - 1))
    return [in_time_order(feed.where(part == p)) for p in range(ARRIVALS)]


def arrivals_ahead(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The feed in four parts of its time span, test devices' messages one part early."""
    feed = messages(spark, sf_dir)
    first, last = feed.agg(F.min("timestamp"), F.max("timestamp")).first()
    stretch = F.floor(ARRIVALS * (F.col("timestamp") - first) / (last - first + 1))
    ahead = F.col("key").cast("string").cast("long") < FIRST_PRODUCTION_DEVICE - DEVICE_OFFSET
    part = F.greatest(stretch - ahead.cast("long"), F.lit(0).cast("long"))
    return [in_time_order(feed.where(part == p)) for p in range(ARRIVALS)]


_landed: dict[tuple[str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the feed as JSON files, written once per application."""
    known = (spark.conf.get("spark.app.id"), sf_dir)
    if known not in _landed:
        path = scratch_path(spark, "landed")
        in_time_order(messages(spark, sf_dir)).write.json(path)
        _landed[known] = path
    return _landed[known]
