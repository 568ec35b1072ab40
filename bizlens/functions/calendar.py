"""Calendar rules as column expressions.

- ``sunday_week``: week of year, weeks start on Sunday, days before the first
  Sunday are week 0 (range 0-53)
- ``iso_yearweek``: ISO year * 100 + ISO week (2021-01-01 -> 202053)
- ``day_name`` / ``month_name``: full English names
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sunday_week(d) -> Column:
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def seven_day_week(d) -> Column:
    """1-7 January is week 1, 8-14 is week 2, ..."""
    return F.ceil(F.dayofyear(_col(d)) / 7).cast("int")


def iso_yearweek(d) -> Column:
    d = _col(d)
    return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("int")


# fixed values: English day names from Sunday, month names from January
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December")


def day_name(d) -> Column:
    """Full day name. Looked up by day of week, so a timestamp without time
    zone never passes through the session time zone (as ``date_format`` does)."""
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), F.dayofweek(_col(d)))


def month_name(d) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(_col(d)))


def ymd_text(d, sep: str = "-") -> Column:
    """``yyyy-MM-dd`` (or with another separator) of a date or a timestamp
    without time zone, independent of the session time zone."""
    d = _col(d)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat_ws(sep, F.lpad(F.year(d).cast("string"), 4, "0"), two(F.month(d)), two(F.dayofmonth(d)))


def ntz_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a whole-second timestamp without time zone."""
    return _col(ts).cast("timestamp_ntz").cast("string")


def wall_clock_instant(ts) -> Column:
    """A zoned timestamp whose UTC reading equals the wall clock of ``ts``
    (for watermarks, which need a zoned timestamp)."""
    ts = _col(ts)
    secs = (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts))
    return F.timestamp_seconds(secs)


def month_start(d) -> Column:
    return F.trunc(_col(d), "MM")


def wall_seconds(ts) -> Column:
    """Seconds since 1970-01-01 00:00 of the wall clock of a timestamp without
    time zone (decimal, microseconds kept). Unlike ``timestamp_diff`` or
    ``unix_timestamp`` this never consults the session time zone, so a wall
    time inside a daylight-saving gap is not moved."""
    ts = _col(ts)
    return (F.unix_date(F.to_date(ts)).cast("decimal(20,6)") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.date_part(F.lit("SECOND"), ts))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (negative when end is earlier),
    truncated toward zero like TIMESTAMPDIFF."""
    return (wall_seconds(end) - wall_seconds(start)).cast("bigint")


def minutes_between(start, end) -> Column:
    """Whole minutes elapsed from ``start`` to ``end`` (truncated toward zero)."""
    return ((wall_seconds(end) - wall_seconds(start)) / 60).cast("bigint")


_TS_TEXT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"


def parse_timestamp_ntz(c) -> Column:
    """``yyyy-MM-dd HH:mm[:ss[.ffffff]]`` text (surrounding blanks allowed) ->
    timestamp without time zone; anything else (``'null'``, ``''``, impossible
    dates) -> NULL. One pattern test, then the fields by position; built from
    the fields, so no session time zone (and no DST gap) is involved."""
    t = F.trim(_col(c))
    part = [F.substring(t, pos, n).try_cast("int") for pos, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2))]
    seconds = F.coalesce(F.substring(t, 18, 9).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    return F.when(t.rlike(_TS_TEXT), F.try_make_timestamp_ntz(*part, seconds))
