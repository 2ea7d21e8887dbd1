"""The calendar feature table of the older builder: time fields, school calendar, holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import calendar_ops, timefeatures


def build_calendar_features(df: DataFrame, ts: str = "Timestamp", keep=()) -> DataFrame:
    """``keep`` columns + Load, Date, Hour, Day, IsWeekend, Month, Season, 6 school flags, 13 federal holiday
    flags, 4 fixed-date flags, thanksgiving, blackFriday, cyberMonday, easter (Timestamp dropped)."""
    out = timefeatures.add_date_hour(df.select(*keep, "Load", ts), ts)
    out = timefeatures.add_time_features(out).drop(ts)
    out = calendar_ops.add_school_flags(out, "Date")
    out = calendar_ops.add_holiday_features(out, "Date")
    return out
