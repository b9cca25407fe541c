"""Calendar keys, boundary-counting differences and packed date/time decoding.

Everything works on ``timestamp_ntz`` and never converts through the session
time zone, so results do not move with daylight saving or cluster settings.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _col, int_div


def parse_as_of(as_of) -> datetime:
    """Accept a ``datetime`` or an ISO string."""
    return as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))


def ts_lit(as_of) -> Column:
    """A ``timestamp_ntz`` literal that Catalyst folds and pushes into scans."""
    return F.lit(parse_as_of(as_of).isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(as_of, days) -> datetime:
    """``as_of`` minus a possibly fractional number of days (6.9 days = 596,160 seconds)."""
    return parse_as_of(as_of) - timedelta(seconds=round(float(days) * 86_400, 6))


def week_of_year(ts) -> Column:
    """US week number: week 1 holds January 1 and weeks start on Sunday."""
    ts = _col(ts)
    since_new_year = F.dayofyear(ts) - 1
    first_weekday = F.pmod(F.dayofweek(ts) - 1 - since_new_year, F.lit(7))  # of January 1, Sunday = 0
    return (int_div(since_new_year + first_weekday, 7) + 1).cast("int")


def week_slot(ts) -> Column:
    """Year and US week as one int, ``yyyyww``: the cheap grouping key behind :func:`year_week`."""
    return F.year(_col(ts)) * 100 + week_of_year(ts)


def week_label(slot) -> Column:
    """``'yyyy.ww'`` of a :func:`week_slot`."""
    text = _col(slot).cast("string")
    return F.concat(F.substring(text, 1, 4), F.lit("."), F.substring(text, 5, 2))


def year_week(ts) -> Column:
    """``'yyyy.ww'`` with the US week number, zero padded."""
    return week_label(week_slot(ts))


def date_key(ts) -> Column:
    """``yyyymmdd`` as an int."""
    ts = _col(ts)
    return (F.year(ts) * 10_000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def weekday_name(ts) -> Column:
    return F.date_format(_col(ts), "EEEE")


def midnight(ts) -> Column:
    """Start of the day, still ``timestamp_ntz``."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def wall_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 on the wall clock, as bigint."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}


def boundary_diff(unit: str, start, end) -> Column:
    """Unit boundaries crossed from ``start`` to ``end``: 00:00:59 to 00:01:00 is one minute."""
    if unit == "day":
        return F.datediff(F.to_date(_col(end)), F.to_date(_col(start))).cast("bigint")
    size = _UNIT_SECONDS[unit]
    return F.floor(wall_seconds(end) / size).cast("bigint") - F.floor(wall_seconds(start) / size).cast("bigint")


def add_seconds(ts, seconds) -> Column:
    """Shift by a number of seconds held in a column."""
    zero = F.lit(0)
    return _col(ts) + F.make_dt_interval(zero, zero, zero, _col(seconds).cast("decimal(18,6)"))


def tick_time(as_of, now_ms, tick_ms) -> Column:
    """Wall time of a millisecond tick, given the tick count read at ``as_of``."""
    return add_seconds(ts_lit(as_of), (_col(tick_ms) - _col(now_ms)).cast("decimal(18,3)") / 1000)


def packed_datetime(date_int, time_int) -> Column:
    """Decode ``yyyymmdd`` and ``hhmmss`` integers; NULL when they are not a valid time."""
    d, t = _col(date_int), _col(time_int)
    return F.try_make_timestamp_ntz(
        int_div(d, 10_000).cast("int"),
        (int_div(d, 100) % 100).cast("int"),
        (d % 100).cast("int"),
        int_div(t, 10_000).cast("int"),
        (int_div(t, 100) % 100).cast("int"),
        (t % 100).cast("decimal(16,6)"),
    )


def packed_seconds(hhmmss) -> Column:
    """Seconds in a packed ``hhmmss`` duration. Hours are not limited to two digits."""
    d = _col(hhmmss)
    return (int_div(d, 10_000) * 3_600 + (int_div(d, 100) % 100) * 60 + d % 100).cast("int")
