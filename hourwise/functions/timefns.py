"""Date / time column functions.

Timestamps are kept as TIMESTAMP_NTZ holding *UTC wall-clock* values, the way
the naive UTC strings of a landed load file are meant; every function here is
independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"
LOCAL_FORMAT = "MM/dd/yyyy HH:mm:ss"
UTC_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_local(text: Column | str, fmt: str = LOCAL_FORMAT) -> Column:
    """Wall-clock text (``MM/dd/yyyy HH:mm:ss``) -> TIMESTAMP_NTZ; a malformed value raises under ANSI."""
    return F.to_timestamp_ntz(_c(text), F.lit(fmt))


def try_parse_local(text: Column | str, fmt: str = LOCAL_FORMAT) -> Column:
    """Like parse_local, NULL for malformed values."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def local_to_utc(
    local: Column | str,
    label: Column | str,
    tz: str = EASTERN,
    dst_label: str = "EDT",
    std_offset_hours: int = 5,
    dst_offset_hours: int = 4,
) -> Column:
    """Local wall time plus a standard/daylight label -> UTC wall time (TIMESTAMP_NTZ).

    The label settles the repeated autumn hour.  Any label other than
    ``dst_label`` counts as standard time.  Where the label contradicts the
    zone's rule for an unambiguous time, the zone's rule wins; inside the
    spring gap the label's offset is used.  ``local`` may be text in
    TIMESTAMP_NTZ (use parse_local first for text).
    """
    l = _c(local)
    is_dst = F.coalesce(_c(label) == F.lit(dst_label), F.lit(False))
    first = F.when(is_dst, F.lit(dst_offset_hours)).otherwise(F.lit(std_offset_hours))
    other = F.when(is_dst, F.lit(std_offset_hours)).otherwise(F.lit(dst_offset_hours))
    cand = l + F.make_interval(hours=first)
    alt = l + F.make_interval(hours=other)

    def back(u: Column) -> Column:
        return F.convert_timezone(F.lit("UTC"), F.lit(tz), u)

    return F.when(back(cand) == l, cand).when(back(alt) == l, alt).otherwise(cand)


def utc_text(ts: Column | str, fmt: str = UTC_TEXT_FORMAT) -> Column:
    return F.date_format(_c(ts), fmt)


def hour_start(ts: Column | str) -> Column:
    """Truncate to the hour, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("HOUR", _c(ts)).cast("timestamp_ntz")


def day_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")


def is_weekend(d: Column | str) -> Column:
    return (F.weekday(_c(d)) >= 5).cast("int")


def season_name(month: Column | str) -> Column:
    m = _c(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .when(m.isin(9, 10, 11), "Fall")
    )


def season_number(month: Column | str) -> Column:
    """Winter 1, Spring 2, Summer 3, Fall 4."""
    m = _c(month)
    return (
        F.when(m.isin(12, 1, 2), 1)
        .when(m.isin(3, 4, 5), 2)
        .when(m.isin(6, 7, 8), 3)
        .when(m.isin(9, 10, 11), 4)
    )


def iso_day_of_week(d: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7 (Spark's dayofweek is Sunday = 1)."""
    return F.weekday(_c(d)) + 1


def cyclical(value: Column | str, period: float) -> tuple[Column, Column]:
    """(sin, cos) encoding of a periodic integer such as hour (24) or month (12)."""
    angle = F.lit(2.0 * 3.141592653589793 / period) * _c(value)
    return F.sin(angle), F.cos(angle)


def compact_date(text: Column | str) -> Column:
    """``yyyyMMdd`` text -> DATE."""
    return F.to_date(_c(text), "yyyyMMdd")
