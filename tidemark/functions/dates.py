"""Date arithmetic on wall-clock times.

Timestamps are handled as TIMESTAMP_NTZ throughout, so no result depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.types import TIMESTAMP, literal

_EPOCH = dt.datetime(1970, 1, 1)

#: Microseconds in one unit of a fixed-length part.
_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
PARTS = (*_MICROS, "day", "week", *_MONTHS)


def _part(part: str, allowed: tuple[str, ...] = PARTS) -> str:
    name = part.lower()
    if name not in allowed:
        raise ValueError(f"unknown date part {part!r}; use one of {', '.join(allowed)}")
    return name


def _wall(value: Column) -> Column:
    return value.cast("timestamp_ntz")


def _epoch_micros(value: Column) -> Column:
    """Microseconds since 1970 on the wall clock.  (A timestamp difference would go through the session's zone and its gaps.)"""
    wall = _wall(value)
    day = F.unix_date(wall.cast("date")).cast("bigint") * 86_400_000_000
    fraction = (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("bigint")
    minutes = (F.hour(wall) * 60 + F.minute(wall)).cast("bigint")
    return day + minutes * 60_000_000 + fraction


def make_date(year: Column | int, month: Column | int, day: Column | int) -> Column:
    as_column = lambda v: F.lit(v) if isinstance(v, int) else v
    return F.make_date(as_column(year), as_column(month), as_column(day))


def date_trunc(part: str, value: Column) -> Column:
    """Start of the part holding ``value``, as a wall-clock timestamp.  Weeks start on Monday."""
    name = _part(part)
    if name in _MICROS:
        excess = F.pmod(_epoch_micros(value), F.lit(_MICROS[name]))
        return F.timestamp_add("MICROSECOND", -excess, _wall(value))
    day = _wall(value).cast("date")
    return _wall(day if name == "day" else F.trunc(day, name))


def dateadd(part: str, amount: Column | int, value: Column) -> Column:
    """``value`` moved by ``amount`` parts; month ends are clamped (Jan 31 + 1 month = Feb 28/29)."""
    name = _part(part)
    quantity = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(name.upper(), quantity, _wall(value))


def _ordinal(name: str, value: Column) -> Column:
    """Number of the part holding ``value``; two values share a number iff no boundary lies between them."""
    if name in _MICROS:
        micros = _epoch_micros(value)
        return (micros - F.pmod(micros, F.lit(_MICROS[name]))) / F.lit(_MICROS[name])
    day = _wall(value).cast("date")
    if name == "day":
        return F.unix_date(day)
    if name == "week":
        # 1970-01-04 was a Sunday, so shifting by 4 puts every week boundary on a Sunday.
        return F.floor((F.unix_date(day) + 4) / 7)
    months = F.year(day) * 12 + F.month(day) - 1
    return F.floor(months / _MONTHS[name])


def datediff(start: Column, end: Column, part: str) -> Column:
    """Signed number of part boundaries crossed from ``start`` to ``end``.  Weeks start on Sunday.

    This counts boundaries, not elapsed time: one second across midnight is one day.
    """
    name = _part(part)
    return (_ordinal(name, end) - _ordinal(name, start)).cast("bigint")


def last_day(value: Column, part: str) -> Column:
    """Last calendar day of the month, quarter or year holding ``value``."""
    name = _part(part, tuple(_MONTHS))
    first = F.trunc(_wall(value).cast("date"), name)
    return F.date_sub(F.add_months(first, _MONTHS[name]), 1)


def to_time(text: Column) -> Column:
    """Parse a timestamp text to a wall-clock timestamp."""
    return F.to_timestamp_ntz(text)


def clock(now: dt.datetime | None = None) -> dt.datetime:
    """The one 'now' of a run (UTC wall clock).  Pass it on; never read the clock twice in one run."""
    return now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def as_time(now: dt.datetime | None) -> Column:
    """A wall-clock moment as a literal."""
    return literal(now, TIMESTAMP)


def as_utc(value: Column, data_type: T.DataType) -> Column:
    """A column as a wall-clock timestamp: instants (TIMESTAMP) in UTC, whatever the session's zone; others as they are."""
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(value), as_time(_EPOCH))
    return _wall(value)


def as_instant(value: Column, data_type: T.DataType) -> Column:
    """A column as an instant (TIMESTAMP): wall-clock times count as UTC, whatever the session's zone."""
    if isinstance(data_type, T.TimestampType):
        return value
    return F.timestamp_micros(_epoch_micros(value))


def boundaries_between(start: dt.datetime, end: dt.datetime, part: str) -> int:
    """``datediff`` of two known moments."""
    name = _part(part)

    def ordinal(moment: dt.datetime) -> int:
        if name in _MICROS:
            return (moment - _EPOCH) // dt.timedelta(microseconds=_MICROS[name])
        days = moment.toordinal() - _EPOCH.toordinal()
        if name in ("day", "week"):
            return days if name == "day" else (days + 4) // 7
        return (moment.year * 12 + moment.month - 1) // _MONTHS[name]

    return ordinal(end) - ordinal(start)
