import base64
import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pulsemart.constants import ENVELOPE_SCHEMA  # noqa: E402
from pulsemart.session import configure  # noqa: E402

T0 = 1733000000


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def messages(spark):
    """Messages from (topic, payload) pairs; a payload is a dict, text or None."""

    def build(pairs):
        rows = []
        for i, (topic, payload) in enumerate(pairs):
            text = json.dumps(payload) if isinstance(payload, dict) else payload
            value = None if text is None else bytearray(text.encode())
            rows.append((bytearray(b"k"), value, topic, 0, i, T0 * 1000 + i))
        return spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1)

    return build


@pytest.fixture(scope="session")
def readings(messages):
    """bpm messages from (device, time, heartrate) triples."""

    def build(triples):
        return messages(
            [("bpm", {"device_id": d, "time": t, "heartrate": h}) for d, t, h in triples]
        )

    return build


@pytest.fixture(scope="session")
def rows():
    """A result as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r]
        )

    return collect


def encode(text):
    return base64.b64encode(text.encode()).decode()
