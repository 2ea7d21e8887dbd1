"""Calendar fields of a timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timefns as T


def add_date_hour(df: DataFrame, ts: str = "Timestamp", date_col: str = "Date", hour_col: str = "Hour") -> DataFrame:
    """``Date`` and ``Hour`` of the timestamp (UTC wall clock, as the feature table is UTC)."""
    return df.withColumns({date_col: F.to_date(F.col(ts)), hour_col: F.hour(F.col(ts))})


def add_time_features(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """``Day`` name, ``IsWeekend``, ``Month``, ``Season``."""
    d = F.col(date_col)
    return df.withColumns({
        "Day": T.day_name(d),
        "IsWeekend": T.is_weekend(d),
        "Month": F.month(d),
        "Season": T.season_name(F.month(d)),
    })


def add_numeric_date(df: DataFrame, ts: str = "Timestamp", drop_text: bool = True) -> DataFrame:
    """``Year``, ``DayOfYear``, ``DayOfWeek`` (Monday = 1), ``seasonNum``; drops Season and Day."""
    t = F.col(ts)
    out = df.withColumns({
        "Year": F.year(t),
        "DayOfYear": F.dayofyear(t),
        "DayOfWeek": T.iso_day_of_week(t),
        "seasonNum": T.season_number(F.month(t)),
    })
    return out.drop("Season", "Day") if drop_text else out


def add_cyclical(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """sin/cos encodings of hour of day, day of week and month of year."""
    t = F.col(ts)
    hs, hc = T.cyclical(F.hour(t), 24)
    ws, wc = T.cyclical(F.weekday(t), 7)
    ms, mc = T.cyclical(F.month(t) - 1, 12)
    return df.withColumns({"hourSin": hs, "hourCos": hc, "dowSin": ws, "dowCos": wc, "monthSin": ms, "monthCos": mc})


def format_timestamp(df: DataFrame, ts: str = "Timestamp", out: str = "TimestampText", fmt: str = T.UTC_TEXT_FORMAT) -> DataFrame:
    """Timestamp as text."""
    return df.withColumn(out, T.utc_text(ts, fmt))
