"""Runs of repeated words in a text, found through a dictionary of basic factors.

A basic factor is a stretch of 2^k words; factors of equal words get equal names, each level's
names from pairs of names of the level below. Where a factor of length L and its next occurrence
lie within 2 L words, their distance d, at most L, proposes a period. In a run of period q, with
q <= L < 2 q and at least 3 q words, the occurrences of such a factor follow one another at
exactly q, as a word that is no power of a shorter one meets itself at multiples of its length
only. So each run is proposed at the level of its period, as an arithmetic progression, and by
its smallest period. Proposals are extended by comparing words q apart and told apart by place.

Texts are independent: a task takes them as they come, in Arrow batches, one text at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import SPACES, text_of

#: A run has at least this many words, and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3

words_of = re.compile(rf"[^{re.escape(SPACES)}]+").findall


@dataclass(frozen=True, order=True)
class Run:
    start: int
    period: int
    length: int


def numbered(words: list[str]) -> np.ndarray:
    """Equal words as equal numbers below the number of words."""
    known: dict[str, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def proposals(names: np.ndarray) -> Iterator[tuple[int, int]]:
    """(place, period) for each stretch of neighbouring places that propose the same period.

    Goes up by level until no factor occurs twice, or factors are too long for a run's period.
    """
    n, size = len(names), 1
    while len(names):
        order = np.argsort(names, kind="stable")  # equal names by place
        ranked = names[order]
        same = ranked[1:] == ranked[:-1]
        if not same.any():
            return
        gaps = order[1:] - order[:-1]
        # Periods up to half the length belong to the level below.
        near = np.flatnonzero(same & (gaps <= size) & (2 * gaps > size))
        if len(near):
            places, periods = order[near], gaps[near]
            by_place = np.argsort(places)
            places, periods = places[by_place], periods[by_place]
            new = np.ones(len(places), bool)
            new[1:] = (np.diff(places) != 1) | (np.diff(periods) != 0)
            yield from zip(places[new].tolist(), periods[new].tolist(), strict=True)
        if 2 * size * LEAST_PERIODS > 2 * n:  # the next level's periods are over `size`
            return
        ranks = np.empty(len(names), np.int64)
        ranks[order] = np.concatenate(([0], np.cumsum(~same)))
        names = ranks[:-size] * (ranks.max() + 1) + ranks[size:] if size < len(ranks) else ranks[:0]
        size *= 2


def reach(same: Callable[[int, int], np.ndarray], at: int, border: int, step: int) -> int:
    """How far from `at` towards `border` all comparisons hold; looks ever further ahead."""
    look = 64
    while at != border:
        end = min(at + look, border) if step > 0 else max(at - look, border)
        found = same(at, end) if step > 0 else same(end, at)[::-1]
        wrong = np.flatnonzero(~found)
        if len(wrong):
            return at + step * int(wrong[0])
        at, look = end, 2 * look
    return at


def find_runs(ids: np.ndarray) -> list[Run]:
    """All runs of a sequence of numbers, by start, then period.

    A run is a stretch of least period q and max(24, 3 q) items at least that no item beside it
    extends. Time is that of sorting for each of at most log2(n) levels.
    """
    n = len(ids)
    if n < LEAST_WORDS:
        return []
    found: set[Run] = set()
    latest: dict[int, int] = {}  # end of the last stretch extended, by period
    for place, period in proposals(ids):
        if place + period < latest.get(period, 0):
            # A period has one level, and places rise within a level: this stretch is known.
            continue

        def same(a: int, b: int, q: int = period) -> np.ndarray:
            return ids[a:b] == ids[a + q : b + q]

        first = reach(same, place, 0, -1)
        last = reach(same, place, n - period, 1)  # ids[last] is the first to differ from its copy
        latest[period] = last + period
        length = last + period - first
        if length >= max(LEAST_WORDS, LEAST_PERIODS * period):
            found.add(Run(first, period, length))
    return sorted(found)


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods, as an exact fraction; then the first, then the shortest period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: all but those of a run behind its first period."""
    depth = np.zeros(n + 1, np.int64)
    for run in runs:
        depth[run.start + run.period] += 1
        depth[run.start + run.length] -= 1
    return np.cumsum(depth)[:n] == 0


def with_planted_run(words: list[str], doc_id: int | None) -> list[str]:
    """The words of the contract: a tenth of the documents repeats a stretch up to its end.

    A document without a number stays as it is.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[: n - a]


def collapse(
    rows: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    prepare: Callable[[list[str], int | None], list[str]] | None = None,
) -> DataFrame:
    """Per row: its id, n_words, runs (start, length, period; by start, then period) and the text
    without repetitions, its kept words joined by one blank.

    Words are `[^\\x20\\x09-\\x0D]+`; `prepare` may change them first. Null and empty texts have no
    words and no runs and give an empty text. Repeated rows each get a row, an empty table none.
    Other columns are not read. A text is worked on whole; a task's memory is that of its longest.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(
            pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        )
        for batch in batches:
            numbers, found, texts = [], [], []
            ids = batch.column(0).to_pylist()
            for number, text in zip(ids, batch.column(1), strict=True):
                words = words_of(text.as_py())
                if prepare is not None:
                    words = prepare(words, number)
                runs = find_runs(numbered(words))
                if runs:
                    keep = kept_words(len(words), runs).tolist()
                    shown = [w for w, stays in zip(words, keep, strict=True) if stays]
                else:
                    shown = words
                numbers.append(len(words))
                found.append(
                    [{"start": r.start, "length": r.length, "period": r.period} for r in runs]
                )
                texts.append(" ".join(shown))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(numbers, pa.int64()),
                    pa.array(found, run_type),
                    pa.array(texts, pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    picked = rows.select(F.col(id_column).cast("long").alias("id"), text_of(text).alias("text"))
    return picked.mapInArrow(
        work,
        "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed string",
    ).withColumnRenamed("id", id_column)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The strongest run of each row and SHA-256 of its runs and of its collapsed text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "period", "exponent_milli"]
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ["n_runs", *names, "runs_sha256"]}
            for row in batch.column("runs").to_pylist():
                runs = [Run(r["start"], r["period"], r["length"]) for r in row]
                best = strongest(runs)
                lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
                out["n_runs"].append(len(runs))
                figures = (
                    (best.start, best.length, best.period, 1000 * best.length // best.period)
                    if best
                    else (None,) * 4
                )
                for name, figure in zip(names, figures, strict=True):
                    out[name].append(figure)
                out["runs_sha256"].append(hashlib.sha256(lines.encode()).hexdigest())
            arrays = [pa.array(out[n], pa.int64()) for n in ["n_runs", *names]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *arrays,
                    pa.array(out["runs_sha256"], pa.string()),
                    batch.column("collapsed_sha256"),
                ],
                ["id", "n_runs", *names, "runs_sha256", "collapsed_sha256"],
            )

    whole = F.sha2(F.col("collapsed").cast("binary"), 256)
    return (
        found.select(F.col(id_column).alias("id"), "runs", whole.alias("collapsed_sha256"))
        .mapInArrow(
            work,
            "id long, n_runs long, start long, length long, period long, exponent_milli long, "
            "runs_sha256 string, collapsed_sha256 string",
        )
        .withColumnRenamed("id", id_column)
    )
