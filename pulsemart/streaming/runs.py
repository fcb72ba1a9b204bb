"""Starting streaming queries, running them in order and summing up what they did."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsemart.constants import WATERMARK_DELAY
from pulsemart.operators.cleaning import split_topic
from pulsemart.operators.partials import Figures
from pulsemart.operators.payloads import parse_once, topic_rows
from pulsemart.operators.topics import BPM, Topic
from pulsemart.session import stateful_settings
from pulsemart.sinks import versions
from pulsemart.sinks.batches import write_batch
from pulsemart.sources.tables import stream_table
from pulsemart.streaming import queries


#: Seconds between looks at a running query. Spark keeps a hundred reports unless told otherwise.
POLL_SECONDS = 0.1


def start(
    df: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a table.

    Without `every` it takes what has landed and stops; with an interval such as
    "10 seconds" it goes on until stopped. The checkpoint makes a restart carry on where
    the last run, or a lost driver, left off.
    """
    when = {"availableNow": True} if every is None else {"processingTime": every}
    with stateful_settings(df.sparkSession, state_partitions):
        return (
            df.writeStream.format("parquet")
            .partitionBy(*partition_by)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**when)
            .toTable(table)
        )


def start_updating(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    checkpoint: str,
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep `name` equal to the whole result of a streaming aggregation with these keys.

    A micro-batch hands on the groups that changed (update mode). They take the place of the
    saved rows of the same keys, NULL keys included, in a new version that the view `name` then
    shows, so a reader always finds a whole result. A batch that is replayed changes nothing.
    """
    when = {"availableNow": True} if every is None else {"processingTime": every}

    def merge(batch: DataFrame, batch_id: int) -> None:
        def build(before: DataFrame | None) -> DataFrame:
            return batch if before is None else replaced(before, batch, keys)

        versions.bring_up_to(batch.sparkSession, name, batch_id, build)

    with stateful_settings(df.sparkSession, state_partitions):
        return (
            df.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**when)
            .foreachBatch(merge)
            .start()
        )


def replaced(before: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`before` with the rows of `changes` in place of those with the same keys."""
    both = before.select(F.lit(0).alias("__new"), *before.columns).unionByName(
        changes.select(F.lit(1).alias("__new"), *before.columns)
    )
    others = [c for c in before.columns if c not in keys]
    newest = F.max_by(F.struct(*others), "__new").alias("__row")
    return both.groupBy(*keys).agg(newest).select(
        *(F.col(f"__row.{c}") if c in others else F.col(c) for c in before.columns)
    )


def start_figures(
    rows: DataFrame,
    name: str,
    figures: Figures,
    checkpoint: str,
    every: str | None = None,
    show: str = "*",
) -> StreamingQuery:
    """Keep `name` equal to figures over all rows of a growing table, reading each row once.

    There is no state but the saved partial figures: those of a micro-batch's rows are combined
    with them in a new version. `show` is the select list of the view, say an average out of a
    sum and a count.
    """
    when = {"availableNow": True} if every is None else {"processingTime": every}

    def merge(batch: DataFrame, batch_id: int) -> None:
        more = figures.of_rows(batch)
        versions.bring_up_to(
            batch.sparkSession, name, batch_id, lambda before: figures.combined(before, more), show
        )

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**when)
        .foreachBatch(merge)
        .start()
    )


def refresh_figures(
    spark: SparkSession,
    name: str,
    source: str,
    figures: Figures,
    checkpoint: str,
    show: str = "*",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Bring saved figures up to date with what a table has gained since the last call.

    The table must grow by appending. What a call costs is that of the new rows and of the saved
    figures. The checkpoint says which files are in; `name` is a view of the newest version.
    """
    rows = stream_table(spark, source, files_per_batch)
    finish(start_figures(rows, name, figures, checkpoint, show=show))
    return spark.table(name)


def start_by_batch(
    df: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    after: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append a stream to a table that has a directory for each micro-batch, each row once.

    Rows of a batch whose run was lost before its checkpoint are replaced when it comes again.
    `after` is called when a batch's rows are there and its checkpoint is not.
    """
    when = {"availableNow": True} if every is None else {"processingTime": every}

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, table, batch_id)
        if after is not None:
            after(batch_id)

    return (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**when)
        .foreachBatch(write)
        .start()
    )


def keep_running(
    begin: Callable[[], StreamingQuery],
    done: Callable[[], bool],
    most_restarts: int = 3,
    seconds: float = 600.0,
) -> int:
    """Keep a query with an interval trigger going until `done` says so, then stop it.

    A query that fails is begun again and goes on from its checkpoint, `most_restarts` times at
    most; then its failure is raised, as it is when `seconds` have gone by. Returns the restarts.
    """
    restarts, end = 0, time.monotonic() + seconds
    query = begin()
    try:
        while time.monotonic() < end:
            try:
                if done():
                    query.processAllAvailable()
                    return restarts
                query.awaitTermination(POLL_SECONDS)
            except StreamingQueryException:
                if restarts == most_restarts:
                    raise
                restarts += 1
                query = begin()
    finally:
        query.stop()
    raise TimeoutError(f"not done after {seconds} seconds and {restarts} restarts")


def finish(query: StreamingQuery) -> list:
    """Wait for a query that stops by itself and return a report of each of its micro-batches.

    Its failure is raised here. Spark keeps the newest reports only, so they are taken as they
    arrive; a gap in their numbers means that some were lost, and raises too.
    """
    reports: dict[int, object] = {}

    def take() -> None:
        for report in query.recentProgress:
            # While a stream is idle it reports again under the number of the batch to come.
            if "addBatch" in report.durationMs or report.batchId not in reports:
                reports[report.batchId] = report

    while not query.awaitTermination(POLL_SECONDS):
        take()
    take()
    numbers = sorted(reports)
    if numbers and numbers != list(range(numbers[0], numbers[0] + len(numbers))):
        raise RuntimeError(f"reports of micro-batches were lost; those seen: {numbers}")
    return [reports[n] for n in numbers]


@dataclass
class Summary:
    """What one run of a query did, summed over its micro-batches."""

    batches: int = 0
    input_rows: int = 0
    late_rows: int = 0
    state_rows: int = 0
    observed: dict[str, dict[str, int]] = field(default_factory=dict)


def summarise(progress: Iterable) -> Summary:
    """Sum a query's progress reports. Observed values must be counts.

    `input_rows` is what the sources hand on after pushed-down filters. For rows landed
    take the `ingested` count of the bronze step.
    """
    total = Summary()
    for report in progress:
        total.batches += 1
        total.input_rows += report.numInputRows
        total.late_rows += sum(s.numRowsDroppedByWatermark for s in report.stateOperators)
        total.state_rows = sum(s.numRowsTotal for s in report.stateOperators)
        for name, row in (report.observedMetrics or {}).items():
            sums = total.observed.setdefault(name, {})
            for metric, value in row.asDict().items():
                sums[metric] = sums.get(metric, 0) + (value or 0)
    return total


@dataclass(frozen=True)
class TopicTables:
    """The tables of one topic."""

    parsed: str
    silver: str


@dataclass(frozen=True)
class Tables:
    """The three tables of the streaming run and the folder of their checkpoints."""

    bronze: str
    parsed: str
    silver: str
    checkpoints: str


def ingest(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoints: str,
    files_per_batch: int | None = None,
    lineage: bool = False,
) -> Summary:
    """Bring the bronze table up to date with the files landed.

    It has one directory per topic, so that each topic's query reads its own files only.
    `lineage` adds the file of each row, to tell files landed from files ingested.
    """
    rows = queries.bronze(spark, path, files_per_batch, lineage)
    query = start(rows, table, f"{checkpoints}/bronze", partition_by=["topic"])
    return summarise(finish(query))


def run_topics(
    spark: SparkSession,
    bronze: str,
    topics: Mapping[Topic, TopicTables],
    checkpoints: str,
    *,
    delay: str = WATERMARK_DELAY,
    rule_position: str = "after",
    collapse: bool = False,
    state_partitions: int | None = None,
    files_per_batch: int | None = None,
) -> dict[str, dict[str, Summary]]:
    """Bring the tables of several topics up to date with one bronze table.

    `files_per_batch` bounds the micro-batches of both steps.

    Topics do not wait for one another: all are split at the same time, then all cleaned.
    """
    done: dict[str, dict[str, Summary]] = {topic.name: {} for topic in topics}

    def run_all(step: str, rows_of: Callable[[Topic], DataFrame], table: str) -> None:
        started = {
            topic: start(
                rows_of(topic),
                getattr(tables, table),
                f"{checkpoints}/{topic.name}-{step}",
                state_partitions=state_partitions,
            )
            for topic, tables in topics.items()
        }
        for topic, query in started.items():
            done[topic.name][step] = summarise(finish(query))

    def cleaned(topic: Topic) -> DataFrame:
        rows = stream_table(spark, topics[topic].parsed, files_per_batch)
        return queries.silver(rows, topic, delay, rule_position, collapse)

    def split(topic: Topic) -> DataFrame:
        return split_topic(stream_table(spark, bronze, files_per_batch), topic)

    run_all("parsed", split, "parsed")
    run_all("silver", cleaned, "silver")
    return done


def ingest_payloads(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoints: str,
    files_per_batch: int | None = None,
) -> Summary:
    """Bring a table of messages with VARIANT payloads up to date with the files landed."""
    rows = parse_once(queries.bronze(spark, path, files_per_batch))
    query = start(rows, table, f"{checkpoints}/payloads", partition_by=["topic"])
    return summarise(finish(query))


def run_payload_topics(
    spark: SparkSession,
    payloads: str,
    silver_tables: Mapping[Topic, str],
    checkpoints: str,
    *,
    delay: str = WATERMARK_DELAY,
    rule_position: str = "after",
    collapse: bool = False,
    state_partitions: int | None = None,
    files_per_batch: int | None = None,
) -> dict[str, Summary]:
    """Clean several topics side by side, each straight from the table of parsed payloads."""

    def rows_of(topic: Topic) -> DataFrame:
        parsed = topic_rows(stream_table(spark, payloads, files_per_batch), topic)
        return queries.silver(parsed, topic, delay, rule_position, collapse)

    started = {
        topic: start(
            rows_of(topic),
            table,
            f"{checkpoints}/{topic.name}-payloads-silver",
            state_partitions=state_partitions,
        )
        for topic, table in silver_tables.items()
    }
    return {topic.name: summarise(finish(query)) for topic, query in started.items()}


def run_once(
    spark: SparkSession,
    path: str,
    tables: Tables,
    topic: Topic = BPM,
    *,
    files_per_batch: int | None = None,
    **options,
) -> dict[str, Summary]:
    """Bring the three tables up to date with what has landed, one query after the other.

    A later run with the same `tables` takes only what is new. `options` are those of
    `run_topics`.
    """
    landed = ingest(spark, path, tables.bronze, tables.checkpoints, files_per_batch)
    made = {topic: TopicTables(tables.parsed, tables.silver)}
    done = run_topics(
        spark, tables.bronze, made, tables.checkpoints, files_per_batch=files_per_batch, **options
    )
    return {"bronze": landed, **done[topic.name]}
