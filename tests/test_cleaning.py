"""Messages to cleaned rows: the cases where the obvious code goes wrong."""

import dataclasses
import json

import pytest
from conftest import T0, encode
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import Observation, Row
from pyspark.sql import functions as F

from pulsemart.constants import REFERENCE_BPM_SCHEMA
from pulsemart.functions.columns import epoch_to_timestamp, in_days, normalise_identifier
from pulsemart.operators import cleaning, quality
from pulsemart.operators.topics import BPM, Topic
from pulsemart.plans import batch
from pulsemart.session import scratch_path, scratch_table
from pulsemart.sources import files as source

FEW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def feed_of_400():
    """400 readings 5 s apart, four devices in turn, every 50th from a test device; two twice."""
    triples = []
    for i in range(400):
        device = 102000 + i % 4 - (3000 if i % 50 == 0 else 0)
        triples.append((device, T0 + 0.5 + 5 * i, 60.0 + i % 7))
    return triples + [triples[3], triples[7]]


@pytest.mark.parametrize(
    ("schema", "kept"), [(BPM.payload_schema, 392), (REFERENCE_BPM_SCHEMA, 64)]
)
def test_float_time_merges_distinct_readings(readings, schema, kept):
    topic = dataclasses.replace(BPM, payload_schema=schema)
    parsed = cleaning.split_topic(readings(feed_of_400()), topic)
    assert cleaning.clean(parsed, topic).count() == kept


def test_payload_that_is_not_base64_keeps_its_row(spark, tmp_path):
    lines = [
        {"key": encode("a"), "value": "not base64!", "topic": "bpm", "timestamp": 1},
        {"key": encode("b"), "value": encode("{}"), "topic": "bpm", "timestamp": 2},
    ]
    (tmp_path / "part.json").write_text("\n".join(json.dumps(x) for x in lines))
    read = source.read_messages(spark, str(tmp_path))
    assert [(r["value"], r["topic"]) for r in read.orderBy("timestamp").collect()] == [
        (None, "bpm"),
        (bytearray(b"{}"), "bpm"),
    ]
    assert quality.message_report(read).collect() == [
        Row(topic="bpm", messages=2, undecodable=1)
    ]


def test_payload_that_is_not_json_is_kept_until_cleaning(messages):
    feed = messages(
        [("bpm", "not json"), ("bpm", {"device_id": 102000, "time": T0, "heartrate": 60.0})]
    )
    parsed = cleaning.split_topic(feed, BPM)
    assert parsed.where("device_id IS NULL AND time IS NULL AND heartrate IS NULL").count() == 1
    assert cleaning.clean(parsed, BPM).count() == 1


def test_only_the_topic_asked_for(messages):
    feed = messages([("bpm", {"device_id": 1}), ("workout", {"device_id": 2}), (None, {})])
    assert [r.device_id for r in cleaning.split_topic(feed, BPM).collect()] == [1]


def test_topic_without_event_time_or_rules(messages):
    people = Topic("user_info", "id INT, name STRING", ("id",), time_column=None)
    feed = messages([("user_info", {"id": 1, "name": "b"}), ("user_info", {"id": 1, "name": "a"})])
    kept = cleaning.clean(cleaning.split_topic(feed, people), people, order_by=["name"])
    assert kept.collect() == [Row(id=1, name="a")]


def test_ordered_deduplication_keeps_the_lowest(readings, rows):
    parsed = cleaning.split_topic(
        readings([(102000, T0, 61.0), (102000, T0, 60.0), (102000, T0, None)]), BPM
    )
    assert rows(cleaning.clean(parsed, BPM, order_by=["heartrate"]), "heartrate") == [(60.0,)]
    assert cleaning.clean(parsed, BPM).count() == 1


@FEW
@given(
    st.lists(
        st.tuples(
            st.integers(0, 2),
            st.one_of(st.none(), st.integers(0, 3)),
            st.one_of(st.none(), st.integers(0, 3)),
        ),
        max_size=25,
    )
)
def test_ordered_deduplication_against_brute_force(spark, rows, data):
    df = spark.createDataFrame(data, "k INT, a INT, b INT")
    best = {}
    for k, a, b in data:
        rank = (a is None, a or 0, b is None, b or 0)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, a, b))
    expected = sorted((r for _, r in best.values()), key=lambda r: r[0])
    got = sorted(
        (tuple(r) for r in cleaning.deduplicate(df, ["k"], ["a"]).collect()), key=lambda r: r[0]
    )
    assert got == expected


def test_second_save_is_refused_unless_overwriting(spark, readings):
    feed = readings([(102000, T0, 60.0)])
    parsed, silver = scratch_table(spark, "p"), scratch_table(spark, "s")
    batch.run_topic(feed, BPM, parsed, silver, "errorifexists")
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        batch.run_topic(feed, BPM, parsed, silver, "errorifexists")
    assert batch.run_topic(feed, BPM, parsed, silver).count() == 1


def test_batch_run_counts_what_it_drops(spark, readings):
    counts = Observation()
    feed = readings([(102000, T0, 60.0), (102000, T0, 60.0), (99, T0, 1.0)])
    batch.run_topic(
        feed, BPM, scratch_table(spark, "p"), scratch_table(spark, "s"), observation=counts
    )
    assert counts.get == {"rows_checked": 3, "failed_valid_id": 1, "rows_dropped": 1}


def test_batch_run_keys_are_unique(spark, readings):
    path = scratch_path(spark, "raw")
    readings(feed_of_400()).write.json(path)
    names = [scratch_table(spark, n) for n in ("bronze", "parsed", "silver")]
    silver = batch.run(spark, path, *names)
    assert silver.count() == silver.select("device_id", "timestamp").distinct().count() == 392
    assert spark.table(names[0]).count() == spark.table(names[1]).count() == 402


def test_nan_time_becomes_null(spark):
    df = spark.sql("SELECT double('NaN') AS t UNION ALL SELECT double('1733000000')")
    assert df.where(epoch_to_timestamp("t").isNull()).count() == 1


def test_last_day_is_whole(spark):
    df = spark.sql("SELECT timestamp'2024-12-31 10:00' AS t, date'2024-12-31' AS d")
    raw = df.select((F.col("t") <= F.lit("2024-12-31").cast("timestamp")).alias("x")).first().x
    ours = df.select(in_days("t", "2024-01-01", "2024-12-31"), in_days("d", None, "2024-12-31"))
    assert raw is False
    assert list(ours.first()) == [True, True]
    assert df.where(in_days("t", "2025-01-01")).count() == 0
    assert df.where(in_days("t")).count() == 1


@FEW
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
def test_identifier_against_plain_python(spark, names):
    # Letters and digits in the narrower, Unicode-category sense; see the column's pattern.
    import unicodedata

    def plain(name):
        head = name.split("@")[0].lower()
        return "".join(c if unicodedata.category(c)[0] in "LN" else "_" for c in head)

    usable = [n for n in names if n.isascii()]
    df = spark.createDataFrame([(n,) for n in usable], "n STRING")
    got = {r[0]: r[1] for r in df.select("n", normalise_identifier("n")).collect()}
    assert got == {n: plain(n) for n in usable}


def test_null_rule_result_counts_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "x INT")
    rules = {"big": "x > 2", "known": "x IS NOT NULL"}
    assert quality.quality_report(df, rules).first().asDict() == {
        "rows_checked": 3,
        "failed_big": 2,
        "failed_known": 1,
        "rows_dropped": 2,
    }
    assert [r.x for r in quality.enforce(df, rules).collect()] == [5]


def test_key_check_counts(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k INT")
    parent = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k INT")
    assert quality.key_check(child, parent, "k", "c.k").first().asDict() == {
        "relation": "c.k",
        "matched_rows": 3,
        "orphan_rows": 2,
        "duplicated_parent_keys": 1,
        "unused_parent_keys": 1,
    }
