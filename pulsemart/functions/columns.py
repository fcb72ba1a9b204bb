"""Column expressions: decoding, time, identifiers and exact sums."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    """Bytes holding UTF-8 text, as a string."""
    return _col(c).cast("string")


def as_bytes(c: ColumnOrName) -> Column:
    """The UTF-8 bytes of a string; a JSON writer stores them as base64."""
    return _col(c).cast("string").cast("binary")


def parse_json(c: ColumnOrName, schema: str) -> Column:
    """JSON text or bytes as a struct; text that is not JSON gives a struct of NULLs."""
    return F.from_json(as_text(c), schema)


def epoch_to_timestamp(c: ColumnOrName) -> Column:
    """Epoch seconds as TIMESTAMP; NaN and out-of-range values give NULL, not an error."""
    return _col(c).try_cast("timestamp")


def month_start(c: ColumnOrName) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_col(c).cast("date"), "MM")


def normalise_identifier(c: ColumnOrName) -> Column:
    """The part before '@', lower-cased, with everything but letters and digits as '_'."""
    name = F.split_part(_col(c), F.lit("@"), F.lit(1))
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "_")


def _as_date(day: dt.date | str) -> dt.date:
    if isinstance(day, str):
        return dt.date.fromisoformat(day)
    return day.date() if isinstance(day, dt.datetime) else day


def in_days(
    c: ColumnOrName, first: dt.date | str | None = None, last: dt.date | str | None = None
) -> Column:
    """Whether a DATE or TIMESTAMP falls on a day from `first` to `last`, both included.

    An open bound is None. The test is half-open on the bare column, so it reaches the
    scan as a range filter and includes every hour of the last day.
    """
    test = F.lit(True)
    if first is not None:
        test = _col(c) >= F.lit(_as_date(first))
    if last is not None:
        below = _col(c) < F.lit(_as_date(last) + dt.timedelta(days=1))
        test = below if first is None else test & below
    return test


def in_units(c: ColumnOrName, decimals: int | None) -> Column:
    """Amounts as whole units of their last decimal place, or as they are without one."""
    return _col(c) if decimals is None else F.rint(_col(c) * 10**decimals).cast("long")


def from_units(c: ColumnOrName, decimals: int | None) -> Column:
    """The way back from `in_units`, as DOUBLE."""
    return _col(c) if decimals is None else _col(c) / F.lit(float(10**decimals))


def total(c: ColumnOrName, decimals: int | None = None) -> Column:
    """Sum of a column, as Spark adds it up or in whole units of a decimal place.

    Adding DOUBLEs gives a result that depends on the order of rows, and DECIMALs are slow
    to add. `decimals` says that no value has more decimals than that: cents, say, are then
    added as LONG, exactly and fast, and the sum comes back as DOUBLE. Leave it out if
    values may have more decimals.
    """
    return from_units(F.sum(in_units(c, decimals)), decimals)


def mean(c: ColumnOrName, decimals: int | None = None) -> Column:
    """Average as DOUBLE, from `total` and a count of the values that are not NULL."""
    return total(c, decimals).cast("double") / F.count(c)
