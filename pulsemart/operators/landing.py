"""Landing a table's rows as JSON files, a batch at a time, past a high-water mark.

Where a batch ends is found by counting, not by sorting. Rows are counted in windows that grow
upwards from the mark, so a call reads what lies near the mark, however far the feed goes on. In
the window that takes in the batch, rows are counted by cell, and again within the cell where the
batch ends; where that is a single value, by the next cursor column. The result is an exact upper
bound on the cursor: the batch is a range of the feed, sorted over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemart.constants import MESSAGE_CURSOR, STAGING_ROWS
from pulsemart.sinks.files import append_json
from pulsemart.sources.files import path_exists, read_messages

LAST_LONG = (1 << 63) - 1
#: A count by cell gives at most 2 << CELL_BITS numbers.
CELL_BITS = 10
#: The first window spans 1 << FIRST_BITS values; each further one is 1 << MORE_BITS times as wide.
FIRST_BITS, MORE_BITS = 8, 4
#: Text is compared so many bytes at a time, as one number.
TEXT_BYTES = 6


@dataclass(frozen=True)
class Landed:
    """Rows written by one call, and the mark to pass to the next, with the width of the window
    that took the rows in, as bits, which spares the next call the narrower ones."""

    rows: int
    mark: Row | None
    bits: int = FIRST_BITS


def high_water_mark(df: DataFrame, cursor: Sequence[str] = MESSAGE_CURSOR) -> DataFrame:
    """The greatest cursor as one row of its columns, all NULL if there are no rows."""
    return df.agg(F.max(F.struct(*cursor)).alias("mark")).select("mark.*")


def past(df: DataFrame, mark: Row | None, cursor: Sequence[str] = MESSAGE_CURSOR) -> Column:
    """Whether a row comes after the mark; no mark means every row does.

    The plain range test on the first cursor column adds nothing to the result. It is the
    part a scan can use to skip data.
    """
    if mark is None:
        return F.lit(True)
    types = {f.name: f.dataType for f in df.schema.fields}
    at = F.struct(*(F.lit(mark[c]).cast(types[c]).alias(c) for c in cursor))
    after = F.struct(*cursor) > at
    lead = cursor[0]
    return after if mark[lead] is None else (F.col(lead) >= F.lit(mark[lead])) & after


@dataclass(frozen=True)
class Bound:
    """Rows up to a place in the order: the `rows` for which `below` holds, and any `more` of those
    that are `alike` in every column of the order. `last` is the greatest value of the first
    column among them, a plain range for the scan; `bits` is the width of the window counted."""

    below: Column
    rows: int
    alike: Column | None = None
    more: int = 0
    last: int | None = None
    bits: int = FIRST_BITS


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _part(df: DataFrame, name: str, part: int) -> Column:
    """A column as a whole number that keeps its order, NULL where it is NULL.

    A text is taken TEXT_BYTES bytes at a time, with the number of bytes there are behind them.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        there = F.substring(F.col(name).cast("binary"), 1 + TEXT_BYTES * part, TEXT_BYTES)
        digits = F.rpad(F.hex(there), 2 * TEXT_BYTES, "0")
        return F.shiftleft(F.conv(digits, 16, 10).cast("long"), 8) + F.octet_length(there)
    raise TypeError(f"a batch cannot be cut on {name}, a {kind.simpleString()} column")


def _follows(df: DataFrame, order: Sequence[str], place: tuple[int, int], tie: int) -> tuple[int, int]:
    """Where the order goes on among rows of one value: in the text, if it may, or behind it."""
    k, part = place
    whole = isinstance(df.schema[order[k]].dataType, T.IntegralType) or tie & 0xFF < TEXT_BYTES
    return (k + 1, 0) if whole else (k, part + 1)


def _upwards(df: DataFrame, n: int, value: Column, start: int, bits: int) -> tuple[int, int, int]:
    """(last, rows, bits): the first window upwards from `start` with n rows, or with all there are."""
    while True:
        last = min(start + (1 << bits) - 1, LAST_LONG)
        rows = df.where(value.between(_long(start), _long(last))).count()
        if rows >= n or last == LAST_LONG or df.where(value > _long(last)).isEmpty():
            return last, rows, bits
        bits += MORE_BITS


def _search(
    df: DataFrame, n: int, order: Sequence[str], place: tuple[int, int], low: int, high: int
) -> Bound:
    """The bound of the first n rows by a value from `low` to `high`, of which there are more.

    Each count by cell also tells the values in it, so a cell of one value is known as a tie.
    """
    value, before, exact = _part(df, order[place[0]], place[1]), 0, False
    while high > low and not exact:
        cell = F.shiftright(value, max((high - low).bit_length() - CELL_BITS, 0))
        counts = (
            df.where(value.between(_long(low), _long(high)))
            .groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        for _, rows, first, last in sorted(counts.collect()):
            low, high = first, last
            if before + rows >= n:
                exact = before + rows == n
                break
            before += rows
    if exact:
        return Bound(value <= _long(high), n, last=high)
    tie = value == _long(low)
    inner = _cut(df.where(tie), n - before, order, _follows(df, order, place, low))
    alike = None if inner.alike is None else tie & inner.alike
    below = (value < _long(low)) | (tie & inner.below)
    return Bound(below, before + inner.rows, alike, inner.more, low)


def _cut(df: DataFrame, n: int, order: Sequence[str], place: tuple[int, int]) -> Bound:
    """The bound among rows that are alike in what comes before `place` in the order."""
    if place[0] == len(order):
        return Bound(F.lit(False), 0, F.lit(True), n)
    value = _part(df, order[place[0]], place[1])
    there, nulls, low, high = df.agg(
        F.count(value), F.count_if(value.isNull()), F.min(value), F.max(value)
    ).first()
    none = value.isNull()
    if nulls + there <= n:
        return Bound(F.lit(True), nulls + there)
    if nulls >= n:
        return _among(none, _cut(df.where(none), n, order, (place[0] + 1, 0)))
    return _behind(none, nulls, _search(df.where(~none), n - nulls, order, place, low, high))


def _among(these: Column, inner: Bound) -> Bound:
    """A bound that was found among these rows only."""
    alike = None if inner.alike is None else these & inner.alike
    return Bound(these & inner.below, inner.rows, alike, inner.more)


def _behind(nulls: Column, rows: int, inner: Bound) -> Bound:
    """A bound with the rows without a value in front."""
    return Bound(nulls | inner.below, rows + inner.rows, inner.alike, inner.more, inner.last)


def find_bound(
    df: DataFrame,
    mark: Row | None = None,
    n: int = STAGING_ROWS,
    cursor: Sequence[str] = MESSAGE_CURSOR,
    bits: int = FIRST_BITS,
) -> Bound:
    """Where the next n rows after the mark end.

    The first column of the cursor is a whole number, on which the saved table should be roughly
    sorted, so that scans skip what lies outside a window; the others are whole numbers, text or
    bytes. Behind the cursor the table's other such columns decide, so ties are cut the same way
    each time. The first call looks for the least value; later ones start at the mark.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in cursor and isinstance(f.dataType, (T.IntegralType, T.StringType, T.BinaryType))
    ]
    order, value = [*cursor, *rest], F.col(cursor[0]).cast("long")
    after, start, nulls = df.where(past(df, mark, cursor)), None, 0
    if mark is not None:
        start = mark[cursor[0]]
    if start is None:
        nulls, start = after.agg(F.count_if(value.isNull()), F.min(value)).first()
    if nulls >= n:
        bound = _among(value.isNull(), _cut(after.where(value.isNull()), n, order, (1, 0)))
        return replace(bound, bits=bits)
    if start is None:
        return Bound(value.isNull(), nulls, bits=bits)
    some = after.where(value.isNotNull())
    last, held, bits = _upwards(some, n - nulls, value, start, bits)
    if held > n - nulls:
        found = _search(some, n - nulls, order, (0, 0), start, last)
    else:
        found = Bound(value <= _long(last), held, last=last)
    return replace(_behind(value.isNull(), nulls, found), bits=bits)


def next_batch(
    df: DataFrame,
    mark: Row | None = None,
    n: int = STAGING_ROWS,
    cursor: Sequence[str] = MESSAGE_CURSOR,
) -> DataFrame:
    """The next n rows after the mark, in cursor order, whatever n is.

    With the default cursor, a total order, repeated calls return every row once. With
    `("timestamp",)` rows that share the mark's timestamp are skipped. `df` should be a saved
    table: it is read in narrow ranges several times. Counting runs at once, the rest when the
    result is used; rows that arrive below the bound in between are returned too.
    """
    return _rows(df, mark, n, cursor, find_bound(df, mark, n, cursor))


def _rows(df: DataFrame, mark: Row | None, n: int, cursor: Sequence[str], bound: Bound) -> DataFrame:
    after = df.where(past(df, mark, cursor))
    rows = after.where(bound.below)
    if bound.last is not None:
        lead = F.col(cursor[0])
        rows = rows.where(lead.isNull() | (lead <= F.lit(bound.last)))
    if bound.alike is not None and bound.more:
        # No column tells these apart, so any of them will do.
        rows = rows.unionAll(after.where(bound.alike).limit(bound.more))
    return rows.orderBy(*cursor)


def landed_mark(
    df: DataFrame, path: str, cursor: Sequence[str] = MESSAGE_CURSOR
) -> Row | None:
    """The mark of what already lies in a folder, None if nothing does."""
    if not path_exists(df.sparkSession, path):
        return None
    there = read_messages(df.sparkSession, path, df.schema)
    return there.agg(F.max(F.struct(*cursor)).alias("mark")).first()["mark"]


def land(
    df: DataFrame,
    path: str,
    n: int = STAGING_ROWS,
    mark: Row | None = None,
    cursor: Sequence[str] = MESSAGE_CURSOR,
    bits: int = FIRST_BITS,
) -> Landed:
    """Append the next n rows of a saved table to a folder of JSON files.

    A caller in a loop passes on the returned mark, and the width too. Without a mark, the folder
    is read for it, which costs a pass over everything landed. Rows and new mark are counted as
    they are written. If nothing is new, nothing is written.
    """
    if mark is None:
        mark = landed_mark(df, path, cursor)
    bound = find_bound(df, mark, n, cursor, bits)
    if bound.rows + bound.more == 0:
        return Landed(0, mark, bits)
    seen = Observation()
    append_json(
        _rows(df, mark, n, cursor, bound).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max(F.struct(*cursor)).alias("mark")
        ),
        path,
    )
    counts = seen.get
    return Landed(counts["rows"], counts["mark"], bound.bits)
