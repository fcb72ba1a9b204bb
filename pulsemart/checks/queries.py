"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemart import testdata
from pulsemart.constants import ENVELOPE_SCHEMA, MESSAGE_CURSOR, REFERENCE_BPM_SCHEMA
from pulsemart.functions import columns
from pulsemart.functions.columns import as_text, parse_json
from pulsemart.operators import (
    cleaning,
    connections,
    landing,
    metrics,
    payloads,
    quality,
    questions,
    star,
)
from pulsemart.operators import filters as flt
from pulsemart.operators.partials import Figures
from pulsemart.operators.topics import BPM, Topic
from pulsemart.plans import batch, dashboard
from pulsemart.session import configure, scratch_path, scratch_table
from pulsemart.sinks import files as json_sink
from pulsemart.sinks import tables as sink
from pulsemart.sources import files as source
from pulsemart.sources import tables as table_source
from pulsemart.streaming import late, runs
from pulsemart.streaming import queries as stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The payloads of these are not laid down; the feed made from the test tables has readings there.
WORKOUT = Topic("workout", BPM.payload_schema, BPM.keys)
USER_INFO = Topic("user_info", BPM.payload_schema, BPM.keys)


def query(run: Query) -> Query:
    """Register a query under its function's name."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(run(configure(spark), sf_dir))

    QUERIES[run.__name__] = configured
    return run


def comparable(df: DataFrame) -> DataFrame:
    """DECIMAL as DOUBLE and TIMESTAMP without zone, the types the SQL side returns."""
    target = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    if not any(type(f.dataType) in target for f in df.schema.fields):
        return df
    return df.select(
        *(
            F.col(f"`{f.name}`").cast(target[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in target
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


# ---- inputs -------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str, include_city: bool = False) -> DataFrame:
    return star.order_history(
        testdata.orders(spark, sf_dir),
        testdata.customers(spark, sf_dir),
        testdata.products(spark, sf_dir),
        include_city,
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.read_messages(spark, testdata.landed(spark, sf_dir))


def _bpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed and shaped, but neither filtered nor de-duplicated."""
    return cleaning.shape(cleaning.split_topic(_raw(spark, sf_dir), BPM), BPM)


def _saved_bpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a saved table, so that a filter reads columns and parses nothing."""
    return sink.save(_bpm(spark, sf_dir), scratch_table(spark, "bpm"))


def _readable(messages: DataFrame) -> DataFrame:
    """Messages with their bytes as text and the payload's fields side by side."""
    return (
        messages.withColumn("body", parse_json("value", BPM.payload_schema))
        .withColumn("key", as_text("key"))
        .select("key", "topic", "partition", "offset", "timestamp", "body.*")
    )


def _tables(spark: SparkSession) -> runs.Tables:
    return runs.Tables(
        scratch_table(spark, "bronze"),
        scratch_table(spark, "parsed"),
        scratch_table(spark, "silver"),
        scratch_path(spark, "checkpoints"),
    )


def _cores(spark: SparkSession) -> int:
    """State partitions for a stream here: one per core, whatever shuffles are set to."""
    return spark.sparkContext.defaultParallelism


def _silver(spark: SparkSession, tables: runs.Tables) -> DataFrame:
    """The last table of a streaming run, without those before it."""
    sink.drop(spark, tables.bronze, tables.parsed)
    return spark.table(tables.silver)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The feed before and from the middle of its time span."""
    feed = testdata.messages(spark, sf_dir)
    span = feed.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).first()
    middle = (span["first"] + span["last"]) // 2
    early = F.col("timestamp") < middle
    return testdata.in_time_order(feed.where(early)), testdata.in_time_order(feed.where(~early))


# ---- sources ------------------------------------------------------------------------


@query
def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = source.read_inferred(spark, testdata.landed(spark, sf_dir))
    body = parse_json(F.unbase64("value"), BPM.payload_schema)
    return raw.withColumn("body", body).select(
        "key", "topic", "partition", "offset", "timestamp", "body.*"
    )


@query
def scan_json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(_raw(spark, sf_dir))


@query
def sql_on_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.query_files(
        spark,
        "topic, count(*) AS messages",
        testdata.landed(spark, sf_dir),
        tail="GROUP BY topic",
    )


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "customers")
    sink.save(testdata.customers(spark, sf_dir), name)
    return table_source.read_table(spark, name)


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "bronze")
    rows = stream.bronze(spark, testdata.landed(spark, sf_dir))
    runs.finish(runs.start(rows, name, scratch_path(spark, "checkpoint")))
    return _readable(spark.table(name))


@query
def stream_bpm_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, parsed = scratch_table(spark, "bronze"), scratch_table(spark, "parsed")
    rows = stream.bronze(spark, testdata.landed(spark, sf_dir))
    runs.finish(
        runs.start(rows, raw, scratch_path(spark, "checkpoint"), partition_by=["topic"])
    )
    split = cleaning.split_topic(table_source.stream_table(spark, raw), BPM)
    runs.finish(runs.start(split, parsed, scratch_path(spark, "checkpoint")))
    sink.drop(spark, raw)
    return spark.table(parsed)


@query
def source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.inventory(spark, testdata.landed(spark, sf_dir))


@query
def raw_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.preview_text(spark, testdata.landed(spark, sf_dir))


@query
def raw_preview_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a preview as messages, and how many of them are in the feed."""
    lines = source.preview_text(spark, testdata.landed(spark, sf_dir), 20)
    shown = lines.select(F.from_json("value", ENVELOPE_SCHEMA).alias("m")).select("m.*")
    feed = testdata.messages(spark, sf_dir).withColumn("found", F.lit(1))
    return shown.join(feed, [*MESSAGE_CURSOR, "key", "value"], "left").agg(
        F.count(F.lit(1)).alias("lines"), F.count("found").alias("in_feed")
    )


@query
def find_duplicates_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_source.query_view(
        _bpm(spark, sf_dir),
        "bpm_readings",
        """
        SELECT device_id, timestamp AS time, count(*) AS count
        FROM bpm_readings
        GROUP BY device_id, timestamp
        HAVING count(*) > 1
        ORDER BY count DESC, device_id, time
        """,
    )


# ---- sinks --------------------------------------------------------------------------


@query
def save_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "products")
    sink.save(testdata.products(spark, sf_dir), name)
    return sink.save(testdata.products(spark, sf_dir), name, "overwrite")


@query
def save_error_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first save holds; the second must be refused."""
    name = scratch_table(spark, "products")
    saved = sink.save(testdata.products(spark, sf_dir), name, "errorifexists")
    try:
        sink.save(testdata.products(spark, sf_dir), name, "errorifexists")
    except AnalysisException as refused:
        return saved.select("*", F.lit(refused.getCondition()).alias("second_save"))
    raise AssertionError("the second save was accepted")


@query
def save_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "products")
    sink.save(testdata.products(spark, sf_dir), name)
    return sink.save(testdata.products(spark, sf_dir), name, "append")


@query
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes written as base64 and read back, landed in two appends."""
    path = scratch_path(spark, "json")
    for half in _halves(spark, sf_dir):
        json_sink.append_json(half, path)
    return _readable(source.read_messages(spark, path))


@query
def copy_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    there, here = scratch_table(spark, "source"), scratch_table(spark, "copy")
    sink.save(testdata.opportunities(spark, sf_dir), there)
    copied = sink.copy_table(spark, there, here)
    sink.drop(spark, there)
    return copied


@query
def refresh_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved summary brought up to date after its source has grown."""
    feed, dataset = scratch_table(spark, "feed"), scratch_table(spark, "dataset")
    early, late = _halves(spark, sf_dir)

    def summary() -> DataFrame:
        return spark.table(feed).groupBy("topic").agg(
            F.count("*").alias("messages"), F.max("timestamp").alias("newest")
        )

    sink.save(early, feed)
    sink.refresh(spark, dataset, summary)
    sink.save(late, feed, "append")
    refreshed = sink.refresh(spark, dataset, summary)
    sink.drop(spark, feed)
    return refreshed


# ---- cleaning -----------------------------------------------------------------------


@query
def envelope_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.message_columns(_raw(spark, sf_dir)).withColumn("key", as_text("key")).drop("value")


@query
def demux_bpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.split_topic(_raw(spark, sf_dir), BPM)


@query
def demux_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another topic through the same steps."""
    parsed = scratch_table(spark, "workout")
    silver = scratch_table(spark, "workout_silver")
    rows = batch.run_topic(_raw(spark, sf_dir), WORKOUT, parsed, silver, order_by=["heartrate"])
    sink.drop(spark, parsed)
    return rows


def _with_names(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables of like columns one after the other, with the name of each in front."""
    parts = [df.select(F.lit(name).alias("topic"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def payload_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three topics cleaned from payloads that were parsed once, to VARIANT."""
    name = scratch_table(spark, "payloads")
    parsed = batch.payloads(spark, testdata.landed(spark, sf_dir), name)
    made = {topic: scratch_table(spark, "silver") for topic in (BPM, WORKOUT, USER_INFO)}
    cleaned = batch.run_payload_topics(parsed, made, order_by=["heartrate"])
    sink.drop(spark, name)
    return _with_names(cleaned)


@query
def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the schema given for user_info fits what has landed there."""
    name = scratch_table(spark, "payloads")
    parsed = batch.payloads(spark, testdata.landed(spark, sf_dir), name)
    return payloads.field_counts(parsed, USER_INFO)


@query
def bpm_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpm(spark, sf_dir).withColumnRenamed("timestamp", "time")


@query
def bpm_parsed_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload schema with a 32-bit time: distinct times snap together."""
    narrow = Topic("bpm", REFERENCE_BPM_SCHEMA, BPM.keys, "time", BPM.rules)
    shaped = cleaning.shape(cleaning.split_topic(_raw(spark, sf_dir), narrow), narrow)
    return shaped.groupBy("device_id", "timestamp").agg(F.count("*").alias("readings"))


@query
def bpm_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, parsed = scratch_table(spark, "bronze"), scratch_table(spark, "bpm_bronze")
    silver = scratch_table(spark, "bpm_silver")
    rows = batch.run(spark, testdata.landed(spark, sf_dir), bronze, parsed, silver)
    sink.drop(spark, bronze, parsed)
    return rows


@query
def dedup_deterministic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per device and day: the one with the lowest heart rate, then the earliest."""
    days = _bpm(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    return cleaning.deduplicate(days, ["device_id", "day"], order_by=["heartrate"])


@query
def distinct_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_topics(_raw(spark, sf_dir))


@query
def distinct_topics_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "bronze")
    return quality.distinct_topics(batch.bronze(spark, testdata.landed(spark, sf_dir), name))


@query
def find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = _bpm(spark, sf_dir).withColumnRenamed("timestamp", "time")
    return quality.find_duplicates(readings, ["device_id", "time"])


@query
def test_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.test_devices(_saved_bpm(spark, sf_dir))


@query
def quality_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.enforce(_saved_bpm(spark, sf_dir), BPM.rules)


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_bpm(spark, sf_dir), BPM.rules)


@query
def message_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.message_report(_raw(spark, sf_dir))


@query
def avg_bpm_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_by(
        _bpm(spark, sf_dir), "device_id", "heartrate", "avg_heartrate", testdata.DECIMALS
    )


@query
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.table(spark, sf_dir, "events")
    return events.select("event_id", parse_json("props", "k INT")["k"].alias("k"))


@query
def normalise_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = testdata.customers(spark, sf_dir)
    address = F.concat("customername", F.lit("@"), F.col("city"))
    return people.select("customerid", columns.normalise_identifier(address).alias("identifier"))


# ---- landing ------------------------------------------------------------------------


@query
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.high_water_mark(_raw(spark, sf_dir), ("timestamp",))


@query
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).agg(F.count("*").alias("rows"))


def _saved_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a saved table, from which rows are staged."""
    feed = testdata.in_time_order(testdata.messages(spark, sf_dir))
    return sink.save(feed, scratch_table(spark, "feed"))


@query
def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch of a replay: what follows the mark left by the first."""
    feed = _saved_feed(spark, sf_dir)
    first = landing.next_batch(feed)
    mark = landing.high_water_mark(first).first()
    return landing.next_batch(feed, mark).select(*MESSAGE_CURSOR)


@query
def landing_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed landed in a few calls; every row must arrive once."""
    feed = _saved_feed(spark, sf_dir)
    path = scratch_path(spark, "replay")
    size = -(-feed.count() // 4)
    step = landing.land(feed, path, size)
    while step.rows:
        step = landing.land(feed, path, size, step.mark, bits=step.bits)
    return _readable(source.read_messages(spark, path))


# ---- streaming ----------------------------------------------------------------------


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    path = testdata.landed(spark, sf_dir)
    runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    return _silver(spark, tables)


@query
def stream_silver_rule_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    path = testdata.landed(spark, sf_dir)
    runs.run_once(
        spark, path, tables, rule_position="before", state_partitions=_cores(spark)
    )
    return _silver(spark, tables)


@query
def stream_silver_rule_at_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark)
    path = testdata.landed(spark, sf_dir)
    runs.run_once(
        spark, path, tables, rule_position="at_watermark", state_partitions=_cores(spark)
    )
    return _silver(spark, tables)


@query
def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics cleaned side by side from one bronze table."""
    bronze, checkpoints = scratch_table(spark, "bronze"), scratch_path(spark, "checkpoints")
    made = {
        topic: runs.TopicTables(scratch_table(spark, "parsed"), scratch_table(spark, "silver"))
        for topic in (BPM, WORKOUT, USER_INFO)
    }
    runs.ingest(spark, testdata.landed(spark, sf_dir), bronze, checkpoints)
    runs.run_topics(spark, bronze, made, checkpoints, state_partitions=_cores(spark))
    sink.drop(spark, bronze, *(tables.parsed for tables in made.values()))
    return _with_names({topic.name: spark.table(t.silver) for topic, t in made.items()})


@query
def stream_payload_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of payloads parsed once, to VARIANT."""
    parsed, checkpoints = scratch_table(spark, "payloads"), scratch_path(spark, "checkpoints")
    made = {topic: scratch_table(spark, "silver") for topic in (BPM, WORKOUT, USER_INFO)}
    runs.ingest_payloads(spark, testdata.landed(spark, sf_dir), parsed, checkpoints)
    runs.run_payload_topics(spark, parsed, made, checkpoints, state_partitions=_cores(spark))
    sink.drop(spark, parsed)
    return _with_names({topic.name: spark.table(name) for topic, name in made.items()})


@query
def stream_incremental_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the feed, then the rest, then nothing new."""
    path, tables = scratch_path(spark, "landing"), _tables(spark)
    for half in _halves(spark, sf_dir):
        json_sink.append_json(half, path)
        runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    return _silver(spark, tables)


@query
def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half lands first, so the earlier half comes too late."""
    path, tables = scratch_path(spark, "landing"), _tables(spark)
    early, late = _halves(spark, sf_dir)
    json_sink.append_json(late, path)
    runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    json_sink.append_json(early, path)
    second = runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    return _silver(spark, tables).agg(F.count("*").alias("kept_rows")).select(
        "kept_rows",
        F.lit(second["bronze"].observed["ingested"]["rows"]).cast("long").alias("landed_rows"),
        F.lit(second["silver"].late_rows).cast("long").alias("late_rows"),
    )


def _run_keeping_late(spark: SparkSession, sf_dir: str) -> late.LateTables:
    """The feed in four parts, each a micro-batch, with a third of its rows one part late."""
    path, bronze = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    checkpoints = scratch_path(spark, "checkpoints")
    names = (scratch_table(spark, n) for n in ("arrivals", "silver", "report"))
    tables = late.LateTables(*names)
    for part in testdata.arrivals(spark, sf_dir):
        json_sink.append_json(part, path)
        runs.ingest(spark, path, bronze, checkpoints)
        parsed = cleaning.split_topic(table_source.stream_table(spark, bronze), BPM)
        runs.finish(
            late.start(
                parsed, BPM, tables, f"{checkpoints}/late", testdata.ARRIVAL_DELAY, order_by=["heartrate"]
            )
        )
    sink.drop(spark, bronze)
    return tables


@query
def stream_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch what became of the rows landed."""
    return spark.table(_run_keeping_late(spark, sf_dir).report)


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows kept and the rows that came too late, side by side."""
    tables = _run_keeping_late(spark, sf_dir)
    shown = {"kept": spark.table(tables.silver), "late": late.late_rows(spark, tables)}
    parts = [df.select(F.lit(name).alias("fate"), *df.columns) for name, df in shown.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def stream_rule_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and dropped with the rule in each position, over four batches in which test
    devices run a quarter of the time ahead: where they move the watermark, good rows are late."""
    path, bronze = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    parsed, checkpoints = scratch_table(spark, "parsed"), scratch_path(spark, "checkpoints")
    silver = {p: scratch_table(spark, "silver") for p in stream.RULE_POSITIONS}
    dropped = dict.fromkeys(silver, 0)
    for part in testdata.arrivals_ahead(spark, sf_dir):
        json_sink.append_json(part, path)
        runs.ingest(spark, path, bronze, checkpoints)
        split = cleaning.split_topic(table_source.stream_table(spark, bronze), BPM)
        runs.finish(runs.start(split, parsed, f"{checkpoints}/parsed"))
        started = {}
        for position, table in silver.items():
            rows = stream.silver(
                table_source.stream_table(spark, parsed), BPM, testdata.ARRIVAL_DELAY, position
            )
            started[position] = runs.start(
                rows, table, f"{checkpoints}/{position}", state_partitions=_cores(spark)
            )
        for position, running in started.items():
            observed = runs.summarise(runs.finish(running)).observed
            dropped[position] += observed.get("quality", {}).get("rows_dropped", 0)
    sink.drop(spark, bronze, parsed)
    counts = [
        spark.table(table).agg(
            F.lit(position).alias("position"),
            F.count(F.lit(1)).alias("kept"),
            F.lit(dropped[position]).cast("long").alias("dropped"),
            F.max("timestamp").alias("newest"),
        )
        for position, table in silver.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def stream_continuous_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with an interval trigger that fails with a batch written and not yet checkpointed."""
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    checkpoint, failed, written = scratch_path(spark, "checkpoint"), [], set()
    halves = _halves(spark, sf_dir)
    json_sink.append_json(halves[0], path)

    def after(batch: int) -> None:
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("lost between two batches")
        if batch == 0:
            json_sink.append_json(halves[1], path)
        written.add(batch)

    runs.keep_running(
        lambda: runs.start_by_batch(stream.bronze(spark, path), table, checkpoint, "1 second", after),
        done=lambda: 1 in written,
    )
    return _readable(spark.table(table))


@query
def landed_not_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in files that are in bronze, and in files that have landed since."""
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    early, late_half = _halves(spark, sf_dir)
    json_sink.append_json(early, path)
    runs.ingest(spark, path, table, scratch_path(spark, "checkpoints"), lineage=True)
    json_sink.append_json(late_half, path)
    status = source.landing_status(spark, path, spark.table(table))
    landed = source.with_lineage(source.read_messages(spark, path))
    return (
        landed.join(status, source.SOURCE_FILE)
        .groupBy(F.when(F.col("rows").isNull(), "pending").otherwise("ingested").alias("status"))
        .agg(F.count(F.lit(1)).alias("messages"))
    )


@query
def avg_bpm_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages after two growths of their source, the second one brought up to date twice."""
    parsed, averages = scratch_table(spark, "parsed"), scratch_table(spark, "averages")
    checkpoint = scratch_path(spark, "checkpoint")
    for half in _halves(spark, sf_dir):
        rows = cleaning.shape(cleaning.split_topic(half, BPM), BPM)
        sink.save(rows, parsed, "append")
        for _ in range(2):
            means = metrics.average_by(
                table_source.stream_table(spark, parsed),
                "device_id", "heartrate", "avg_heartrate", testdata.DECIMALS,
            )
            runs.finish(
                runs.start_updating(
                    means, averages, ["device_id"], checkpoint, state_partitions=_cores(spark)
                )
            )
    sink.drop(spark, parsed)
    return spark.table(averages)


@query
def refresh_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved sums and counts of readings, brought up to date after each of three growths."""
    feed, name = scratch_table(spark, "feed"), scratch_table(spark, "figures")
    checkpoint = scratch_path(spark, "checkpoint")
    readings = testdata.messages(spark, sf_dir).withColumn(
        "body", parse_json("value", BPM.payload_schema)
    )
    figures = Figures(
        ("topic",),
        {
            "messages": ("count", "*"),
            "newest": ("max", "timestamp"),
            "rated": ("count", "heartrate"),
            "units": ("sum", f"CAST(rint(heartrate * {10**testdata.DECIMALS}) AS LONG)"),
        },
    )
    show = f"topic, messages, newest, units / {10**testdata.DECIMALS}D / rated AS avg_heartrate"
    rows = readings.select("topic", "offset", "timestamp", "body.heartrate")
    for third in range(3):
        sink.save(rows.where(F.col("offset") % 3 == third), feed, "append")
        found = runs.refresh_figures(spark, name, feed, figures, checkpoint, show)
    return found


# ---- sales --------------------------------------------------------------------------


@query
def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query
def order_history_with_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, include_city=True)


@query
def opportunity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.opportunity_history(
        testdata.opportunities(spark, sf_dir), testdata.customers(spark, sf_dir)
    )


@query
def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, deals = testdata.orders(spark, sf_dir), testdata.opportunities(spark, sf_dir)
    people, goods = testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir)
    return (
        quality.key_check(orders, people, "customerid", "orders.customerid")
        .unionByName(quality.key_check(orders, goods, "productid", "orders.productid"))
        .unionByName(quality.key_check(deals, people, "customerid", "opportunities.customerid"))
    )


@query
def find_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's keys, found from the values alone."""
    return connections.find_connections(
        {
            "orders": testdata.orders(spark, sf_dir),
            "customers": testdata.customers(spark, sf_dir),
            "products": testdata.products(spark, sf_dir),
            "opportunities": testdata.opportunities(spark, sf_dir),
        }
    )


@query
def find_connections_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the first stretch of opportunities only, as a parent that lacks some."""
    deals = testdata.opportunities(spark, sf_dir)
    some = testdata.customers(spark, sf_dir).where(F.col("customerid") % 10 != 0)
    return connections.find_connections({"customers": some, "opportunities": deals}, least=0.8)


@query
def sales_vs_goal(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = testdata.GOAL_PERIOD
    return metrics.sales_vs_goal(
        testdata.orders(spark, sf_dir), first=first, last=last, decimals=testdata.DECIMALS
    )


@query
def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.monthly_orders(_history(spark, sf_dir), testdata.DECIMALS)


@query
def avg_amount_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.amount_by_product(_history(spark, sf_dir), decimals=testdata.DECIMALS)


@query
def avg_amount_by_product_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.amount_by_product(
        _history(spark, sf_dir), by_id=True, decimals=testdata.DECIMALS
    )


@query
def sum_amount_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.amount_by_product(
        _history(spark, sf_dir), "sum", decimals=testdata.DECIMALS
    )


@query
def revenue_share_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.share_by_state(_history(spark, sf_dir), decimals=testdata.DECIMALS)


@query
def order_share_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.share_by_state(_history(spark, sf_dir), "orders")


@query
def quantity_by_rep_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.quantity_by_rep_state(_history(spark, sf_dir))


@query
def browse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.browse(_history(spark, sf_dir), "orderdate", descending=True)


@query
def browse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five pages of a thousand rows, newest orders first, each from the one before."""
    name = scratch_table(spark, "history")
    history = sink.save(_history(spark, sf_dir), name)
    pages, place = [], None
    for number in range(5):
        page = metrics.browse_page(history, "orderdate", 1000, place, descending=True)
        pages.append(page.select(F.lit(number).alias("page"), "*"))
        place = metrics.place_of(page.collect(), place)
        if place is None:
            break
    return reduce(DataFrame.unionByName, pages).drop("orderid", "customerid", "productid")


@query
def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = testdata.orders(spark, sf_dir)
    return orders.orderBy(*orders.columns).limit(10)


def _dashboard(spark: SparkSession, sf_dir: str) -> dashboard.Dashboard:
    return dashboard.Dashboard(
        {
            dashboard.ORDER_HISTORY: _history(spark, sf_dir),
            dashboard.GOAL: testdata.orders(spark, sf_dir),
        },
        widgets=dashboard.sales_widgets(testdata.DECIMALS, period=testdata.GOAL_PERIOD),
    )


def _on_dates() -> flt.Filter:
    chosen = flt.date_range("orderdate", "1997-03-01", "1998-08-31")
    return flt.Filter(dashboard.ORDER_HISTORY, chosen, page=dashboard.MAIN_PAGE)


def _on_products() -> flt.Filter:
    chosen = flt.any_of("productid", [3, 7, 11, 13, 17, 19, 23, 42, 77, 101])
    return flt.Filter(dashboard.ORDER_HISTORY, chosen)


def _on_cell() -> flt.Filter:
    cell = flt.clicked({"salesrep": "Supplier#000000007", "customer_state": "NATION_2"})
    return flt.Filter(dashboard.ORDER_HISTORY, cell, page=dashboard.MAIN_PAGE, source=dashboard.HEATMAP)


@query
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dashboard(spark, sf_dir).filtered(_on_dates()).show("Order History")


@query
def filter_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dashboard(spark, sf_dir).filtered(_on_products()).show("Order History")


@query
def cross_filter_rep_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dashboard(spark, sf_dir).filtered(_on_cell()).show("Order History")


@query
def filter_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The goal counter keeps its value, and the browse page heeds only the global filter."""
    page = _dashboard(spark, sf_dir).filtered(_on_dates(), _on_products(), _on_cell())
    goal = page.show("Sales Goal").select(
        F.lit("Sales Goal").alias("widget"), F.col("Total_Sales").alias("amount")
    )
    listed = page.show("Browse").agg(
        columns.total("orderamt", testdata.DECIMALS).alias("amount")
    )
    return goal.unionByName(listed.select(F.lit("Browse").alias("widget"), "amount"))


@query
def dashboard_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chart of the page under a date and a product filter, in one pass."""
    return dashboard.page_in_one_pass(
        _history(spark, sf_dir), [_on_dates(), _on_products()], decimals=testdata.DECIMALS
    )


def _on_slice() -> flt.Filter:
    state = flt.clicked({"customer_state": "NATION_3"})
    return flt.Filter(
        dashboard.ORDER_HISTORY, state, page=dashboard.MAIN_PAGE, source="Revenue Share by State"
    )


@query
def dashboard_clicked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page with a slice and a bar clicked: each keeps its own chart as it is."""
    month = flt.clicked({"order_month": dt.date(1997, 5, 1)})
    bar = flt.Filter(
        dashboard.ORDER_HISTORY, month, page=dashboard.MAIN_PAGE, source="Order History"
    )
    history = _history(spark, sf_dir).withColumn("order_month", columns.month_start("orderdate"))
    return dashboard.page_in_one_pass(
        history, [_on_dates(), _on_slice(), bar], decimals=testdata.DECIMALS, with_share=True
    )


@query
def stream_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a streaming run says it did: rows landed, kept, and dropped by the rules."""
    tables = _tables(spark)
    path = testdata.landed(spark, sf_dir)
    done = runs.run_once(spark, path, tables, state_partitions=_cores(spark))
    dropped = done["silver"].observed["quality"]["rows_dropped"]
    sink.drop(spark, tables.bronze, tables.parsed)
    kept = spark.table(tables.silver).count()
    landed = done["bronze"].observed["ingested"]["rows"]
    return spark.createDataFrame([(landed, kept, dropped)], "landed long, kept long, dropped long")


@query
def dashboard_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.page_in_one_pass(_history(spark, sf_dir), decimals=testdata.DECIMALS)


@query
def opportunities_by_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(testdata.opportunities(spark, sf_dir), "salesphase", "opportunities")


@query
def opportunities_by_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(testdata.opportunities(spark, sf_dir), "salesrep", "opportunities")


@query
def customers_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.customers_in_state(
        testdata.customers(spark, sf_dir), "NATION_2", testdata.STATE_CODES
    )


@query
def list_customers_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.list_customers_in_state(
        testdata.customers(spark, sf_dir), "nation two", testdata.STATE_CODES
    )


@query
def unknown_state_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.list_customers_in_state(
        testdata.customers(spark, sf_dir), "Nation Nowhere", testdata.STATE_CODES
    )


@query
def revenue_by_rep_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.revenue_by_rep_in_state(
        testdata.orders(spark, sf_dir),
        testdata.customers(spark, sf_dir),
        "Nation Two",
        testdata.STATE_CODES,
        testdata.DECIMALS,
    )


@query
def top_rep_in_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.top_rep_in_state(
        testdata.orders(spark, sf_dir),
        testdata.customers(spark, sf_dir),
        "Nation Two",
        testdata.STATE_CODES,
        testdata.DECIMALS,
    )
