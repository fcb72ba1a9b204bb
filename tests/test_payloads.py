"""Payloads parsed once to VARIANT and read by path."""

import re

from conftest import T0

from pulsemart.operators import cleaning, payloads
from pulsemart.operators.topics import BPM, Topic
from pulsemart.plans import batch
from pulsemart.session import scratch_path, scratch_table
from pulsemart.sinks.files import append_json
from pulsemart.streaming import runs

USERS = Topic(
    "user_info",
    "id LONG, city STRING, tags ARRAY<STRING>, seen DOUBLE",
    ("id",),
    "seen",
    paths={"id": "$.user.id", "city": "$.user['home city']", "tags": "$.tags"},
)

PAIRS = [
    ("user_info", {"user": {"id": 1, "home city": "Perth"}, "tags": ["a", "b"], "seen": T0}),
    ("user_info", {"user": {"id": "2"}, "seen": T0 + 1}),
    ("user_info", {"user": {"id": "x"}, "tags": "no list", "seen": None}),
    ("user_info", '{"user": {"id": 1, "home city": "Perth"}, "tags": ["a", "b"], "seen": ' + f"{T0}}}"),
    ("user_info", "[1, 2]"),
    ("user_info", "no JSON {"),
    ("user_info", ""),
    ("user_info", None),
    ("bpm", {"device_id": 102001, "time": T0 + 0.5, "heartrate": 61.25}),
    ("bpm", {"device_id": 1, "time": T0, "heartrate": 60}),
    ("bpm", "no JSON"),
]


def test_paths_types_and_payloads_that_do_not_fit(messages, rows):
    parsed = payloads.parse_once(messages(PAIRS))
    found = rows(payloads.topic_rows(parsed, USERS))
    assert sorted(map(str, found)) == sorted(
        map(
            str,
            [(1, "Perth", ["a", "b"], float(T0))] * 2
            + [(2, None, None, float(T0 + 1))]
            + [(None, None, None, None)] * 5,
        )
    )


def test_by_path_as_by_schema(messages, rows):
    raw = messages(PAIRS)
    assert rows(payloads.topic_rows(payloads.parse_once(raw), BPM)) == rows(cleaning.split_topic(raw, BPM))


def test_names_with_any_characters(spark, messages):
    raw = messages([("t", {"it's": 1, "a.b": 2, "c\\d": 3})])
    parsed = payloads.parse_once(raw)
    for name, value in (("it's", 1), ("a.b", 2)):
        assert parsed.select(payloads.at(payloads.path_of(name), "int")).first()[0] == value


def test_what_has_landed_is_discovered(spark, messages):
    parsed = payloads.parse_once(messages(PAIRS))
    found = {r["topic"]: r for r in payloads.discover(parsed).collect()}
    assert (found["bpm"]["messages"], found["bpm"]["unparsed"]) == (3, 1)
    assert (found["user_info"]["messages"], found["user_info"]["unparsed"]) == (8, 3)
    assert "device_id: BIGINT" in found["bpm"]["schema"]
    fit = {r["field"]: tuple(r)[1:] for r in payloads.field_counts(parsed, USERS).collect()}
    assert fit == {"id": (8, 3, 1), "city": (8, 2, 0), "tags": (8, 2, 1), "seen": (8, 3, 0)}


def test_one_parse_and_the_scan_reads_the_paths(spark, messages, conf):
    path, name = scratch_path(spark, "raw"), scratch_table(spark, "payloads")
    append_json(messages(PAIRS), path)
    parsed = batch.payloads(spark, path, name)
    text = cleaning.clean(payloads.topic_rows(parsed, BPM), BPM)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"parse_json|from_json", text)
    assert re.search(r"PartitionFilters: \[isnotnull\(topic#\d+\), \(topic#\d+ = bpm\)\]", text)
    # Typed fields of the payload are what the scan returns, not the payload.
    assert re.search(r"ReadSchema: struct<body:struct<0:", text)


def test_batch_and_stream_agree(spark, messages, rows):
    path, checkpoints = scratch_path(spark, "raw"), scratch_path(spark, "checkpoints")
    append_json(messages(PAIRS), path)
    parsed = batch.payloads(spark, path, scratch_table(spark, "payloads"))
    made = {t: scratch_table(spark, "silver") for t in (BPM, USERS)}
    inside = batch.run_payload_topics(parsed, made)
    streamed = {t: scratch_table(spark, "stream_silver") for t in (BPM, USERS)}
    table = scratch_table(spark, "stream_payloads")
    landed = runs.ingest_payloads(spark, path, table, checkpoints)
    assert landed.observed["ingested"]["rows"] == len(PAIRS)
    runs.run_payload_topics(spark, table, streamed, checkpoints, state_partitions=2)
    for topic, name in streamed.items():
        assert rows(spark.table(name)) == rows(inside[topic.name])
    assert [r["device_id"] for r in inside["bpm"].collect()] == [102001]
    assert sorted(str(r["id"]) for r in inside["user_info"].collect()) == ["1", "2", "None"]
