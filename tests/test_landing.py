"""Landing batches past a high-water mark."""

import pytest
from conftest import T0
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsemart.constants import ENVELOPE_SCHEMA, MESSAGE_CURSOR
from pulsemart.operators import landing
from pulsemart.session import scratch_path
from pulsemart.sources.files import read_messages


@pytest.fixture
def table(spark):
    def build(cursors):
        rows = [(None, None, t, p, o, ts) for ts, t, p, o in cursors]
        return spark.createDataFrame(rows, ENVELOPE_SCHEMA)

    return build


def land_all(df, path, n, cursor=MESSAGE_CURSOR):
    calls = 0
    step = landing.land(df, path, n, cursor=cursor)
    while step.rows:
        calls += 1
        step = landing.land(df, path, n, step.mark, cursor)
    return calls


@pytest.mark.parametrize(("cursor", "copied"), [(("timestamp",), 8), (MESSAGE_CURSOR, 10)])
def test_ties_across_a_batch_edge(spark, table, cursor, copied):
    source = table([(T0 + i // 3, "bpm", 0, i) for i in range(10)])
    path = scratch_path(spark, "ties")
    land_all(source, path, 4, cursor)
    assert read_messages(spark, path).count() == copied


def test_mark_of_zero_is_a_mark(spark, table):
    source = table([(0, "bpm", 0, 0), (5, "bpm", 0, 1)])
    path = scratch_path(spark, "zero")
    first = landing.land(source, path, 1)
    assert (first.rows, first.mark["timestamp"]) == (1, 0)
    # The mark is now found in the folder.
    assert landing.land(source, path, 1).mark["timestamp"] == 5
    assert landing.land(source, path, 1).rows == 0
    assert read_messages(spark, path).count() == 2


def test_rows_without_time_come_first_and_once(spark, table):
    source = table([(None, "bpm", 0, 0), (None, "bpm", 0, 1), (3, "bpm", 0, 2), (3, None, 0, 3)])
    path = scratch_path(spark, "nulls")
    assert land_all(source, path, 1) == 4
    assert sorted(r.offset for r in read_messages(spark, path).collect()) == [0, 1, 2, 3]


def test_nothing_new_writes_nothing(spark, table):
    source = table([(1, "bpm", 0, 0)])
    path = scratch_path(spark, "quiet")
    mark = landing.land(source, path, 5).mark
    files = read_messages(spark, path).inputFiles()
    assert landing.land(source, path, 5, mark) == landing.Landed(0, mark)
    assert read_messages(spark, path).inputFiles() == files


def test_empty_source(spark, table):
    assert landing.land(table([]), scratch_path(spark, "none")) == landing.Landed(0, None)


cursors = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from(["a", "b"]), st.just(0), st.integers(0, 99)),
    unique=True,
    max_size=20,
)


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(cursors, st.integers(1, 9))
def test_replay_copies_every_row_once(spark, table, data, n):
    source = table(data)
    path = scratch_path(spark, "replay")
    calls = land_all(source, path, n)
    assert calls == -(-len(data) // n)
    if data:
        copied = read_messages(spark, path).select(*MESSAGE_CURSOR).collect()
        assert sorted(tuple(r) for r in copied) == sorted(data)


ODD_VALUES = [None, None, -(2**63), -5, 0, 1, 1, 2, 3, 4, 7, 8, 1000, 2**40, 2**62, 2**63 - 1]


def test_bounds_at_every_size_and_up_to_the_last_long(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(ODD_VALUES)], "t LONG, i INT")
    for n in (1, 2, 3, 6, 7, 14, 15, 16, 20):
        got = [r.t for r in landing.next_batch(df, None, n, ("t", "i")).collect()]
        assert got == ODD_VALUES[:n]


TEXTS = ["", "\0", "\0\0", "abcdef", "abcdef\0", "abcdefa", "abcdefg", "abcdefghijklm", "é", "𝄞", None]


def test_ties_are_cut_on_text_in_its_own_order(spark):
    """Ties of the number are cut on text, by bytes; texts that are prefixes come first."""
    data = [(5, t) for t in TEXTS] + [(4, "z"), (6, "a")]
    df = spark.createDataFrame(data, "t LONG, name STRING").repartition(3)
    ordered = [tuple(r) for r in df.orderBy("t", "name").collect()]
    for n in range(1, len(data) + 1):
        got = [tuple(r) for r in landing.next_batch(df, None, n, ("t", "name")).collect()]
        assert got == ordered[:n]


def test_rows_alike_in_every_column_are_counted(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(2, "b")] * 3, "t LONG, name STRING")
    for n in (3, 5, 6, 8, 9):
        assert landing.next_batch(df, None, n, ("t",)).count() == min(n, 8)


def test_a_cursor_that_is_no_number_or_text_is_refused(spark):
    df = spark.createDataFrame([(1, 1.5), (1, 2.5)], "t LONG, x DOUBLE")
    with pytest.raises(TypeError, match="x, a double column"):
        landing.next_batch(df, None, 1, ("t", "x"))


def test_what_a_call_reads_does_not_grow_with_the_feed(spark, monkeypatch):
    """Every window counted, by its ends, in feeds of which the longer ones go on for longer."""
    asked = []
    upwards, search = landing._upwards, landing._search

    def spy_upwards(df, n, value, start, bits):
        last, rows, bits = upwards(df, n, value, start, bits)
        asked.append((start, last))
        return last, rows, bits

    def spy_search(df, n, order, place, low, high):
        asked.append((low, high))
        return search(df, n, order, place, low, high)

    monkeypatch.setattr(landing, "_upwards", spy_upwards)
    monkeypatch.setattr(landing, "_search", spy_search)
    widest = {}
    for rows in (2_000, 200_000):
        asked.clear()
        feed = spark.range(rows).select((F.col("id") * 10).alias("t"))
        mark = spark.createDataFrame([(500,)], "t LONG").first()
        got = landing.next_batch(feed, mark, 100, ("t",))
        assert (got.count(), got.agg(F.max("t")).first()[0]) == (100, 1500)
        widest[rows] = max(last - first for first, last in asked)
    assert widest[2_000] == widest[200_000] < 20_000


def test_batches_come_in_order_at_every_size(spark, table):
    feed = table([(T0 + (i * 7919) % 1000, "ab"[i % 2], i % 3, i) for i in range(3000)])
    ordered = [tuple(r) for r in feed.select(*MESSAGE_CURSOR).orderBy(*MESSAGE_CURSOR).collect()]
    for n in (7, 1500, 3000):
        got = landing.next_batch(feed, None, n).select(*MESSAGE_CURSOR).collect()
        assert [tuple(r) for r in got] == ordered[:n]


@pytest.mark.parametrize("n", [2500, 9999, 20000])
def test_large_batch_is_cut_exactly(spark, n):
    """A third of the rows share a timestamp."""
    feed = spark.range(10000).select(
        F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"),
        F.lit("bpm").alias("topic"),
        F.lit(0).cast("long").alias("partition"),
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, 500)
        .otherwise(F.pmod(F.hash("id"), F.lit(1000)))
        .cast("long")
        .alias("timestamp"),
    )
    expected = sorted(tuple(r) for r in feed.select(*MESSAGE_CURSOR).collect())[:n]
    got = landing.next_batch(feed, None, n).select(*MESSAGE_CURSOR).collect()
    assert sorted(tuple(r) for r in got) == expected
