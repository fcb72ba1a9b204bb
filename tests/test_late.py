"""Late rows kept apart, batches that come again, and runs that fail and go on."""

import pytest
from conftest import T0
from pyspark.sql import functions as F

from pulsemart.operators.cleaning import split_topic
from pulsemart.operators.topics import BPM, Topic
from pulsemart.session import scratch_path, scratch_table
from pulsemart.sinks.batches import write_batch
from pulsemart.sinks.files import append_json
from pulsemart.sources import files as source
from pulsemart.streaming import late, queries, runs

BATCHES = [
    [(102000, T0, 60.0), (102000, T0, 60.0), (102001, T0 + 100, 70.0), (99, T0 + 500, 1.0)],
    # Behind T0 + 470: late, even a test device. No time: never late.
    [(102000, T0 + 470, 1.0), (99, T0, 1.0), (102000, T0 + 471, 2.0), (102000, None, 50.0)],
    [(102000, T0 + 471, 3.0), (102000, None, 51.0), (102002, T0 + 5000, 4.0)],
    [(102002, T0 + 5000, 5.0), (102003, T0 + 4970, 6.0), (102003, T0 + 4971, 7.0), (99, None, 1.0)],
]
COUNTS = [(4, 0, 1, 1, 2), (4, 2, 0, 0, 2), (3, 0, 0, 2, 1), (4, 1, 1, 1, 1)]
KINDS = "landed", "late", "dropped", "duplicates", "kept"


@pytest.fixture
def tables(spark):
    return late.LateTables(*(scratch_table(spark, n) for n in ("arrivals", "silver", "report")))


def counts(spark, tables):
    report = spark.table(tables.report).orderBy("batch")
    return [tuple(r) for r in report.select(*KINDS).collect()]


def test_every_row_is_kept_late_dropped_or_a_duplicate(spark, readings, rows, tables):
    for number, triples in enumerate(BATCHES):
        parsed = split_topic(readings(triples), BPM)
        for _ in range(2):  # a batch that comes again changes nothing
            late.clean_batch(parsed, number, BPM, tables, order_by=["heartrate"])
    assert counts(spark, tables) == COUNTS
    assert all(r[0] == sum(r[1:]) for r in COUNTS)
    behind = late.late_rows(spark, tables).select("batch", "device_id", "heartrate")
    assert rows(behind) == rows(
        spark.createDataFrame([(1, 102000, 1.0), (1, 99, 1.0), (3, 102003, 6.0)], behind.schema)
    )


def test_a_batch_lost_before_its_report_is_written_once(spark, readings, rows, tables, monkeypatch):
    first, second = (split_topic(readings(b), BPM) for b in BATCHES[:2])
    late.clean_batch(first, 0, BPM, tables)
    write, calls = late.write_batch, []

    def fails_at_the_report(df, table, batch, partition_by=()):
        if table == tables.report and not calls:
            calls.append(batch)
            raise RuntimeError("lost")
        return write(df, table, batch, partition_by)

    monkeypatch.setattr(late, "write_batch", fails_at_the_report)
    with pytest.raises(RuntimeError, match="lost"):
        late.clean_batch(second, 1, BPM, tables)
    late.clean_batch(second, 1, BPM, tables)
    assert counts(spark, tables) == COUNTS[:2]
    assert spark.table(tables.silver).count() == 4
    assert spark.table(tables.arrivals).count() == 8


def test_as_a_stream(spark, readings, tables):
    path, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    for triples in BATCHES:
        append_json(readings(triples), path)
        parsed = split_topic(queries.bronze(spark, path), BPM)
        runs.finish(late.start(parsed, BPM, tables, checkpoint, order_by=["heartrate"]))
    assert counts(spark, tables) == COUNTS


def test_a_topic_without_event_time_is_refused(spark, tables):
    with pytest.raises(ValueError, match="no event time"):
        late.start(None, Topic("t", "a INT", ("a",), None), tables, "x")


def test_batches_replace_themselves_and_nothing_else(spark, rows):
    table = scratch_table(spark, "b")
    for batch, values in ((0, [1, 2]), (1, [3]), (0, [4]), (2, [])):
        write_batch(spark.createDataFrame([(v,) for v in values], "v INT"), table, batch)
    assert rows(spark.table(table)) == [(3, 1), (4, 0)]


@pytest.mark.parametrize("failures", [0, 2])
def test_a_run_that_fails_goes_on(spark, readings, failures):
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    checkpoint, lost, written = scratch_path(spark, "checkpoint"), [], []
    append_json(readings(BATCHES[0]), path)

    def after(batch):
        if len(lost) < failures:
            lost.append(batch)
            raise RuntimeError("lost")
        written.append(batch)

    def begin():
        return runs.start_by_batch(queries.bronze(spark, path), table, checkpoint, "1 second", after)

    assert runs.keep_running(begin, lambda: bool(written), most_restarts=2) == failures
    assert spark.table(table).count() == len(BATCHES[0])


def test_a_run_that_keeps_failing_raises(spark, readings):
    path = scratch_path(spark, "landing")
    append_json(readings(BATCHES[0]), path)

    def after(batch):
        raise RuntimeError("always lost")

    def begin():
        rows = queries.bronze(spark, path)
        return runs.start_by_batch(rows, scratch_table(spark, "b"), scratch_path(spark, "c"), "1 second", after)

    with pytest.raises(Exception, match="always lost"):
        runs.keep_running(begin, lambda: False, most_restarts=1)


def test_files_that_are_still_to_be_ingested_are_named(spark, readings):
    path, table = scratch_path(spark, "landing"), scratch_table(spark, "bronze")
    checkpoints = scratch_path(spark, "checkpoints")
    append_json(readings(BATCHES[0]), path)
    runs.ingest(spark, path, table, checkpoints, lineage=True)
    known = {r.source_file for r in spark.table(table).select(source.SOURCE_FILE).collect()}
    append_json(readings(BATCHES[1]), path)
    pending = source.pending_files(spark, path, spark.table(table)).collect()
    assert len(pending) == 1 and pending[0].source_file not in known and pending[0].bytes > 0
    status = source.landing_status(spark, path, spark.table(table))
    assert sorted(str(r.rows) for r in status.collect()) == ["4", "None"]
    runs.ingest(spark, path, table, checkpoints, lineage=True)
    assert source.pending_files(spark, path, spark.table(table)).isEmpty()
    assert spark.table(table).where(F.col(source.SOURCE_FILE).isNull()).isEmpty()
