"""Timestamp parsing and presentation.

Measurement times arrive as local wall-clock text without an offset
(``2026-07-10T00:00``); ingestion times as UTC text with ``+00:00``. Both are
parsed to ``TIMESTAMP`` (an instant; offset-less text is read in the session
zone). Parsing uses ``try_to_timestamp`` so malformed text becomes NULL under
ANSI mode instead of failing the whole job.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Text -> TIMESTAMP; NULL for malformed text (never raises)."""
    if fmt is None:
        return F.try_to_timestamp(_col(c))
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def iso_utc_text(c) -> Column:
    """Timestamp -> ISO-8601 text with microseconds and a ``+00:00`` suffix.

    The input is taken as a UTC wall clock (TIMESTAMP_NTZ, or TIMESTAMP in a
    UTC session)."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00")


def to_wallclock(c) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding the session-zone wall clock.

    For offset-less text parsed in the session zone this returns exactly the
    text's wall clock, whatever the session zone is."""
    return _col(c).cast("timestamp_ntz")


def to_utc_wallclock(c) -> Column:
    """TIMESTAMP (instant) -> TIMESTAMP_NTZ holding its UTC wall clock.

    Counted from the epoch in microseconds: going through the session zone's
    wall clock would give the two instants of a repeated hour (clocks going
    back) the same text."""
    seconds = (F.unix_micros(_col(c)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def as_of_column(as_of=None) -> Column:
    """The reference instant for "not in the future" checks.

    ``None`` means ``current_timestamp()`` (fixed once per query by Catalyst).
    A string or ``datetime`` is a wall clock read in the session zone, the same
    way offset-less measurement text is read, so the comparison is zone-free.
    """
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp")
