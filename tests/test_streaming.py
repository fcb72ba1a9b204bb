"""The streaming run: against the batch run, and where arrival order decides the result."""

import dataclasses
import os
import time
from pathlib import Path

import pytest
from conftest import T0
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulsemart import testdata
from pulsemart.operators import cleaning, metrics
from pulsemart.operators.topics import BPM, Topic
from pulsemart.plans import batch
from pulsemart.session import scratch_path, scratch_table
from pulsemart.sinks.files import append_json
from pulsemart.sources.tables import stream_table
from pulsemart.streaming import queries, runs

SF_DIR = "/root/testdata/sf0.01"

FILES = {
    "a": [(102000, T0, 60.0), (102000, T0, 60.0), (102001, T0 + 1, 70.0), (99, T0 + 500, 1.0)],
    "b": [
        (102000, T0 + 10, 61.0),
        (102001, T0 + 1, 70.0),
        (102000, None, 50.0),
        (102000, None, 51.0),
    ],
    "c": [(102000, T0 + 2000, 61.0)],
    "d": [(102000, T0 + 20, 61.0), (102000, T0 + 2001, 62.0)],
}


@pytest.fixture(scope="module")
def tables(spark):
    def build():
        names = [scratch_table(spark, n) for n in ("bronze", "parsed", "silver")]
        return runs.Tables(*names, scratch_path(spark, "checkpoints"))

    return build


@pytest.fixture(scope="module")
def four_files(spark, readings, tables):
    """Land and process the four files one after the other, once per set of options."""
    known = {}

    def run(**options):
        options = {"collapse": True, "rule_position": "after", **options}
        key = tuple(sorted(options.items()))
        if key not in known:
            path, made = scratch_path(spark, "landing"), tables()
            done = {}
            for name, triples in FILES.items():
                append_json(readings(triples), path)
                done[name] = runs.run_once(spark, path, made, state_partitions=2, **options)
            known[key] = spark.table(made.silver), done
        return known[key]

    return run


KEPT_AFTER = [(102000, T0), (102001, T0 + 1), (102000, None), (102000, T0 + 2000), (102000, T0 + 2001)]


def kept(silver):
    found = silver.select("device_id", F.unix_timestamp("timestamp").alias("t")).collect()
    return sorted(((r.device_id, r.t) for r in found), key=str)


@pytest.mark.parametrize("collapse", [True, False])
def test_test_devices_advance_the_watermark(four_files, collapse):
    silver, done = four_files(collapse=collapse)
    assert kept(silver) == sorted(KEPT_AFTER, key=str)
    assert done["a"]["silver"].observed["quality"]["rows_dropped"] == 1
    # The second of the two rows without time was a duplicate; (T0 + 10) was late.
    assert done["b"]["silver"].late_rows >= 1


def test_rule_before_keeps_them_from_it(four_files):
    silver, _ = four_files(rule_position="before")
    assert kept(silver) == sorted([*KEPT_AFTER, (102000, T0 + 10)], key=str)


def test_rule_at_watermark_equals_after_with_less_state(four_files):
    after, after_runs = four_files()
    at, at_runs = four_files(rule_position="at_watermark")
    assert kept(at) == kept(after)
    assert at_runs["b"]["silver"].state_rows < after_runs["b"]["silver"].state_rows


def test_plain_filter_at_watermark_moves_below_it(spark, readings):
    """Why the observed count has to be there."""
    path = scratch_path(spark, "landing")
    silver, checkpoint = scratch_table(spark, "s"), scratch_path(spark, "c")
    for triples in FILES.values():
        append_json(readings(triples), path)
        rows = cleaning.shape(cleaning.split_topic(queries.bronze(spark, path), BPM), BPM)
        rows = rows.withWatermark("timestamp", "30 seconds").where("device_id >= 102000")
        rows = rows.dropDuplicates(["device_id", "timestamp"])
        runs.finish(runs.start(rows, silver, checkpoint, state_partitions=2))
    assert spark.table(silver).count() == len(KEPT_AFTER) + 1


def test_rows_without_time_are_never_late(four_files):
    silver, done = four_files()
    assert silver.where("timestamp IS NULL").count() == 1
    # Its key outlives the eviction of all older keys.
    assert done["d"]["silver"].state_rows >= 1


def test_rule_can_drop_rows_without_time(spark, readings, tables):
    topic = dataclasses.replace(BPM, rules={**BPM.rules, "has_time": "timestamp IS NOT NULL"})
    path, made = scratch_path(spark, "landing"), tables()
    append_json(readings(FILES["b"]), path)
    done = runs.run_once(spark, path, made, topic, state_partitions=2)
    assert done["silver"].observed["quality"]["failed_has_time"] == 1
    assert spark.table(made.silver).where("timestamp IS NULL").count() == 0


def test_arrival_order_matters(spark, readings, tables):
    hours = [[(102000 + i % 3, T0 + 3600 * h + 30 * i, 60.0) for i in range(100)] for h in range(5)]
    path, made, late = scratch_path(spark, "landing"), tables(), 0
    for h in (1, 0, 4, 2, 3):
        append_json(readings(hours[h]), path)
        late += runs.run_once(spark, path, made, state_partitions=2)["silver"].late_rows
    all_at_once = tables()
    runs.run_once(spark, path, all_at_once, state_partitions=2)
    assert late > 0
    assert spark.table(made.silver).count() == 200
    assert spark.table(all_at_once.silver).count() == 500


def test_time_without_zone_cannot_be_the_event_time(spark):
    stream = spark.readStream.format("rate").load()
    naive = stream.withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))
    with pytest.raises(AnalysisException):
        naive.withWatermark("ts", "30 seconds")
    naive.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "30 seconds")


def test_counts_of_rows_landed_are_before_any_filter(spark, tables):
    made = tables()
    done = runs.run_once(spark, testdata.landed(spark, SF_DIR), made)
    assert done["bronze"].observed["ingested"]["rows"] == 11000
    assert done["parsed"].input_rows == 6600
    assert spark.table(made.parsed).count() == 6600


def test_stream_equals_batch_over_ordered_files(spark, tables, conf):
    """Files in time order, a few per micro-batch, then nothing new."""
    conf("spark.sql.adaptive.enabled", "false")
    path, made = scratch_path(spark, "ordered"), tables()
    testdata.in_time_order(testdata.messages(spark, SF_DIR)).coalesce(1).write.option(
        "maxRecordsPerFile", 1500
    ).json(path)
    conf("spark.sql.adaptive.enabled", "true")
    done = runs.run_once(spark, path, made, files_per_batch=3)
    assert done["bronze"].batches >= 3
    names = [scratch_table(spark, n) for n in ("bronze", "parsed", "silver")]
    by_batch = batch.run(spark, path, *names)
    by_stream = spark.table(made.silver)
    assert by_stream.count() == by_batch.count() == 3956
    assert by_stream.exceptAll(by_batch).isEmpty()
    again = runs.run_once(spark, path, made, files_per_batch=3)
    assert again["bronze"].observed.get("ingested", {}).get("rows", 0) == 0
    assert spark.table(made.silver).count() == 3956


def test_continuous_run_takes_files_as_they_land(spark, readings):
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    append_json(readings(FILES["a"]), path)
    query = runs.start(
        queries.bronze(spark, path), table, scratch_path(spark, "c"), every="500 milliseconds"
    )
    try:
        query.processAllAvailable()
        append_json(readings(FILES["c"]), path)
        until = time.monotonic() + 60
        while spark.table(table).count() < 5 and time.monotonic() < until:
            time.sleep(0.5)
            spark.catalog.refreshTable(table)
    finally:
        query.stop()
    assert spark.table(table).count() == 5


def test_streaming_average_needs_the_whole_result(spark, readings):
    parsed = scratch_table(spark, "parsed")
    cleaning.split_topic(readings(FILES["a"]), BPM).write.saveAsTable(parsed)
    average = metrics.average_by(stream_table(spark, parsed), "device_id", "heartrate", "avg")
    with pytest.raises(AnalysisException):
        runs.start(average, scratch_table(spark, "x"), scratch_path(spark, "c"))


def test_copies_are_thinned_before_the_shuffle(spark):
    """A third of the rows are copies of one reading; none of the others is lost."""
    feed = spark.range(0, 30000, numPartitions=3).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("device_id"),
        F.lit(T0).cast("timestamp").alias("timestamp"),
        F.lit(1.0).alias("heartrate"),
    )
    thin = cleaning.collapse_copies(feed, ["device_id", "timestamp"])
    assert thin.count() < 20000 + 30
    assert thin.distinct().count() == feed.distinct().count() == 20001


def test_thinning_treats_null_keys_as_equal_and_keeps_columns(spark):
    feed = spark.createDataFrame(
        [(None, 1, "a"), (None, 1, "b"), (2, None, "c"), (2, 3, "d")], "k INT, j INT, v STRING"
    ).coalesce(1)
    thin = cleaning.collapse_copies(feed, ["k", "j"])
    assert sorted(r.v for r in thin.collect()) == ["a", "c", "d"]


def test_unknown_rule_position_is_refused(spark, readings):
    with pytest.raises(ValueError, match="rule_position"):
        queries.silver(readings([]), BPM, rule_position="later")


def test_counts_do_not_depend_on_the_reports_spark_keeps(spark, readings, conf):
    conf("spark.sql.streaming.numRecentProgressUpdates", "3")
    path = scratch_path(spark, "landing")
    for k in range(8):
        append_json(readings([(102000, T0 + 10 * k + i, 60.0) for i in range(5)]), path)
    table = scratch_table(spark, "bronze")
    done = runs.ingest(spark, path, table, scratch_path(spark, "c"), files_per_batch=1)
    assert done.batches > 3
    assert done.observed["ingested"]["rows"] == spark.table(table).count() == 40


def test_old_files_are_not_skipped(spark, readings):
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    checkpoint = scratch_path(spark, "c")
    append_json(readings(FILES["a"]), path)
    runs.ingest(spark, path, table, checkpoint)
    before = set(Path(path).iterdir())
    append_json(readings(FILES["b"]), path)
    for file in set(Path(path).iterdir()) - before:
        os.utime(file, (time.time() - 30 * 86400,) * 2)
    done = runs.ingest(spark, path, table, checkpoint)
    assert done.observed["ingested"]["rows"] == 4
    assert spark.table(table).count() == 8


def test_rows_without_keys_stay_where_no_rule_refuses_them(spark, messages, tables):
    """One of them, as in batch; payloads that do not parse are told apart in the count."""
    schema = "device_id INT, time DOUBLE, heartrate DOUBLE"
    topic = Topic("workout", schema, ("device_id", "timestamp"))
    path, made = scratch_path(spark, "landing"), tables()
    sent = [{"heartrate": 61.0}] * 5 + [{"device_id": 7, "time": T0, "heartrate": 60.0}] * 2
    append_json(messages([("workout", m) for m in sent]), path)
    done = runs.run_once(spark, path, made, topic, state_partitions=2)
    found = spark.table(made.silver)
    batch_rows = cleaning.clean(spark.table(made.parsed), topic)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, batch_rows.collect()), key=str)
    assert found.where("device_id IS NULL AND heartrate = 61").count() == 1 and found.count() == 2
    assert done["silver"].observed["unparsed"]["rows"] == 0
    append_json(messages([("workout", {"heartrate": 61.0})]), path)
    runs.run_once(spark, path, made, topic, state_partitions=2)
    assert spark.table(made.silver).count() == 2


def test_only_rules_on_the_keys_refuse_rows_without_keys(spark, readings):
    shaped = cleaning.shape(cleaning.split_topic(readings([]), BPM), BPM)
    other = dataclasses.replace(BPM, rules={"alive": "heartrate > 0 OR device_id IS NOT NULL"})
    assert queries.refuses_no_keys(shaped, BPM) and not queries.refuses_no_keys(shaped, other)
