"""Saved results that grow batch by batch: no gap for readers, and no batch twice."""

import pytest
from pyspark.sql import functions as F

from pulsemart.operators import metrics
from pulsemart.operators.partials import Figures
from pulsemart.session import scratch_path, scratch_table
from pulsemart.sinks import tables as sink
from pulsemart.sinks import versions
from pulsemart.sources.tables import stream_table
from pulsemart.streaming import runs

ROWS = "user STRING, bpm LONG"
FIGURES = Figures(
    ("user",),
    {"n": ("count", "bpm"), "total": ("sum", "bpm"), "least": ("min", "bpm"), "most": ("max", "bpm")},
)
GROWTHS = [
    [("a", 1), ("a", 2), (None, 5), ("b", None)],
    [("a", 3), ("c", 4), (None, 7)],
    [("b", 8), ("b", 9), ("a", -4), (None, None)],
]


def plain(rows):
    out = {}
    for user, bpm in rows:
        out.setdefault(user, []).extend([] if bpm is None else [bpm])
    return out


def test_figures_after_each_growth_and_old_rows_are_not_read_again(spark, rows):
    feed, name, checkpoint = scratch_table(spark, "feed"), scratch_table(spark, "f"), scratch_path(spark, "c")
    so_far = []
    for growth in GROWTHS:
        so_far += growth
        sink.save(spark.createDataFrame(growth, ROWS), feed, "append")
        read = stream_table(spark, feed)
        query = runs.start_figures(read, name, FIGURES, checkpoint, show="*, total / n AS mean")
        assert runs.summarise(runs.finish(query)).input_rows == len(growth)
        found = {r["user"]: tuple(r)[1:] for r in spark.table(name).collect()}
        assert found == {
            u: (len(v), sum(v) if v else None, min(v, default=None), max(v, default=None),
                sum(v) / len(v) if v else None)
            for u, v in plain(so_far).items()
        }
    before = versions.last_batch(spark, name)
    runs.refresh_figures(spark, name, feed, FIGURES, checkpoint)
    assert versions.last_batch(spark, name) == before  # nothing new, nothing done


def test_a_replayed_batch_changes_nothing(spark, rows):
    name = scratch_table(spark, "v")
    first = spark.createDataFrame([("a", 1)], ROWS)
    assert versions.current(spark, name) is None and versions.last_batch(spark, name) is None
    assert versions.bring_up_to(spark, name, 0, lambda before: first)
    more = spark.createDataFrame([("b", 2)], ROWS)
    for done in (True, False, False):
        assert versions.bring_up_to(spark, name, 1, lambda before: before.unionAll(more)) is done
    assert rows(spark.table(name)) == [("a", 1), ("b", 2)]


def test_a_batch_that_fails_leaves_what_was_there(spark, rows):
    name = scratch_table(spark, "v")
    versions.bring_up_to(spark, name, 0, lambda before: spark.createDataFrame([("a", 1)], ROWS))

    def broken(before):
        return before.select("user", F.raise_error(F.lit("lost")).cast("long").alias("bpm"))

    with pytest.raises(Exception, match="lost"):
        versions.bring_up_to(spark, name, 1, broken)
    assert rows(spark.table(name)) == [("a", 1)]
    assert versions.last_batch(spark, name) == 0


def test_a_table_of_that_name_is_left_alone(spark):
    name = scratch_table(spark, "t")
    sink.save(spark.createDataFrame([("a", 1)], ROWS), name)
    with pytest.raises(ValueError, match="no view of versions"):
        versions.bring_up_to(spark, name, 0, lambda before: spark.table(name))


def test_readers_of_a_streaming_average_always_find_it(spark, readings, rows, monkeypatch):
    feed, name, checkpoint = scratch_table(spark, "feed"), scratch_table(spark, "avg"), scratch_path(spark, "c")
    seen, save = [], versions.save

    def save_and_look(df, version):
        if spark.catalog.tableExists(name):
            seen.append(len(rows(spark.table(name))))
        saved = save(df, version)
        if spark.catalog.tableExists(name):
            seen.append(len(rows(spark.table(name))))
        return saved

    monkeypatch.setattr(versions, "save", save_and_look)
    so_far = []
    for growth in GROWTHS:
        so_far += growth
        sink.save(spark.createDataFrame(growth, ROWS), feed, "append")
        means = metrics.average_by(stream_table(spark, feed), "user", "bpm", "mean", 0)
        runs.finish(runs.start_updating(means, name, ["user"], checkpoint, state_partitions=2))
    assert seen == [3, 3, 4, 4]
    assert {r["user"]: r["mean"] for r in spark.table(name).collect()} == {
        u: sum(v) / len(v) if v else None for u, v in plain(so_far).items()
    }


def test_changed_rows_take_the_place_of_those_with_their_keys(spark, rows):
    before = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], ROWS)
    changes = spark.createDataFrame([(None, 20), ("d", 4), ("c", None)], ROWS)
    found = runs.replaced(before, changes, ["user"])
    assert rows(found) == rows(
        spark.createDataFrame([("a", 1), (None, 20), ("c", None), ("d", 4)], ROWS)
    )

