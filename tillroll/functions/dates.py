"""Timestamp helpers that keep TIMESTAMP_NTZ values wall-clock exact.

Every helper works on the wall clock alone, so results do not depend on the
session time zone: truncation goes through the DATE of the value (``trunc``)
plus a day-time interval of whole hours/minutes, and epoch milliseconds are
day numbers (``unix_date``) plus the time of day (Spark's ``date_trunc``,
``timestamp_millis`` and ``timestampdiff`` pass through the session zone and
move values in daylight-saving gaps). All are built-in expressions inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


EPOCH = "1970-01-01 00:00:00"
_DATE_UNITS = {"year", "yyyy", "yy", "quarter", "month", "mon", "mm", "week"}


def _epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


_MS_PER_DAY = 86_400_000


def truncate(unit: str, ts: ColumnOrName) -> Column:
    """``date_trunc(unit, ts)`` on the wall clock, returned as TIMESTAMP_NTZ.

    Units: year, quarter, month, week, day, hour, minute, second.
    """
    c = _col(ts).cast("timestamp_ntz")
    u = unit.lower()
    day = c.cast("date")
    if u in _DATE_UNITS:
        return F.trunc(day, u).cast("timestamp_ntz")
    start = day.cast("timestamp_ntz")
    zero = F.lit(0)
    if u in ("day", "dd"):
        return start
    if u == "hour":
        return start + F.make_dt_interval(zero, F.hour(c))
    if u == "minute":
        return start + F.make_dt_interval(zero, F.hour(c), F.minute(c))
    if u == "second":
        return start + F.make_dt_interval(zero, F.hour(c), F.minute(c), F.second(c).cast("decimal(18,6)"))
    raise ValueError(f"unsupported unit: {unit}")


def month_start(ts: ColumnOrName) -> Column:
    return truncate("month", ts)


def day_start(ts: ColumnOrName) -> Column:
    return truncate("day", ts)


def hour_start(ts: ColumnOrName) -> Column:
    return truncate("hour", ts)


def epoch_millis_to_ts(ms: ColumnOrName) -> Column:
    """Epoch milliseconds (BIGINT) to a millisecond TIMESTAMP_NTZ (UTC wall clock)."""
    m = _col(ms).cast("long")
    days = F.floor(m / F.lit(_MS_PER_DAY)).cast("int")
    rest = m - days.cast("long") * _MS_PER_DAY
    seconds = (rest.cast("decimal(18,0)") / F.lit(1000)).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def ts_to_epoch_millis(ts: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ to epoch milliseconds (inverse of :func:`epoch_millis_to_ts`)."""
    c = _col(ts).cast("timestamp_ntz")
    millis_of_minute = F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("long")
    return (
        F.unix_date(c.cast("date")).cast("long") * _MS_PER_DAY
        + F.hour(c).cast("long") * 3_600_000
        + F.minute(c).cast("long") * 60_000
        + millis_of_minute
    )


def minus_months(ts: ColumnOrName, months: int) -> Column:
    """``ts - INTERVAL 'n' MONTH``; stays TIMESTAMP_NTZ."""
    return _col(ts) - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def ts_literal(value: str | _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal from an ISO string, date or datetime.

    Only ISO forms are accepted: month-day-year text such as ``'02-01-2021'``
    is read differently by different engines and is rejected here.
    """
    # Built from ISO text, so the Python process's local zone plays no part.
    return F.lit(parse_ts(value).isoformat(sep=" ")).cast("timestamp_ntz")


def parse_ts(value: str | _dt.datetime | _dt.date) -> _dt.datetime:
    """Python-side twin of :func:`ts_literal` (for building SQL text)."""
    if isinstance(value, _dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    return _dt.datetime.fromisoformat(value)
