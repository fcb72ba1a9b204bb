"""Session settings and the shared folder for anything a job writes on the side."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Results depend on the first two. The adaptive ones split the partition of a hot key in a
# join, even where an aggregation on that key follows, and merge small partitions. With a few
# files open per task, messages need no sort by topic before they are saved by topic.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that every function here relies on, and return the session."""
    for name, value in SQL_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def size_for_input(
    spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20, most: int = 50_000
) -> tuple[int, int]:
    """Set shuffle partitions and scan split size for an input of this size; returns both.

    Shuffles: enough partitions for each to fit in a task's memory, at least one per core,
    and no more than shuffle bookkeeping bears. Adaptive execution merges small ones.
    Scans: splits of 128 MB, up to 1 GB for inputs so large that tasks, and the files that
    each writes, would run into millions.
    """
    cores = spark.sparkContext.defaultParallelism
    shuffles = min(max(-(-input_bytes // partition_bytes), cores), most)
    split = min(max(input_bytes // 100_000, 128 << 20), 1 << 30)
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffles))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    return shuffles, split


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session may leave it unset; it then gets one temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="pulsemart-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/pulsemart/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession) -> str:
    """A database whose tables live below the shared folder; one per application."""
    app = spark.conf.get("spark.app.id")
    name = "pulsemart_" + "".join(c if c.isalnum() else "_" for c in app.lower())
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{shared_dir(spark)}/pulsemart/db-{app}'"
    )
    return name


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new, unused table name in the scratch database."""
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def stateful_settings(spark: SparkSession, state_partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query copies when it starts.

    The number of state partitions is frozen into the checkpoint by the first run, so it is
    worth choosing for the data expected later; None keeps `spark.sql.shuffle.partitions`.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # A micro-batch uploads its changes to the state, not a copy of all of it.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
