"""Feature table builder: load -> UTC -> temperature -> flags -> calendar -> rolling -> daily lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import local_to_utc, parse_local
from ..operators import clean, joins, ordered, timefeatures

FEATURE_COLUMNS = [
    "Load", "Temperature", "hotFlag", "coldFlag", "Date", "Hour", "IsWeekend", "Month",
    "LoadTrailing1", "LoadTrailing2", "LoadTrailing3", "LoadTrailing7", "LoadCentered3", "LoadCentered7",
    "1DayLag", "Year", "DayOfYear", "DayOfWeek", "seasonNum",
]


def clean_load(raw: DataFrame, load_col: str = "Integrated Load", drop=("PTID",)) -> DataFrame:
    """Drop rows without a load value, drop unused columns, name the value ``Load``.

    The zone ``Name`` is kept: it is the series key (the single-zone original
    filtered one zone and dropped it).
    """
    return clean.drop_and_rename(clean.drop_missing(raw, [load_col]), drop, {load_col: "Load"})


def to_utc(df: DataFrame, local_col: str = "Time Stamp", label_col: str = "Time Zone", out: str = "Timestamp") -> DataFrame:
    """Labelled local wall time text -> UTC ``Timestamp`` (TIMESTAMP_NTZ); drops the two input columns."""
    return df.withColumn(out, local_to_utc(parse_local(local_col), label_col)).drop(local_col, label_col)


def build_features(
    load: DataFrame,
    weather: DataFrame,
    *,
    key: str = "series",
    ts: str = "Timestamp",
    weather_ts: str = "Timestamp",
    temp: str = "temp",
    hot: float = 20.0,
    cold: float = 9.0,
    bucket_rows: int | None = ordered.DEFAULT_BUCKET_ROWS,
    check_weather: bool = True,
) -> DataFrame:
    """The hourly feature table for every series of ``load`` (``key``, ``ts`` UTC, ``Load``).

    Timestamp is kept (the original dropped it) so the table stays ordered
    by name rather than by row position.
    """
    # The daily-lag table depends only on the load, so it is built from the
    # input rather than from the rolled frame (which would run the rolling twice).
    # It has one row per series and day -- bounded by the days in the span, not
    # by the raw volume -- so its one-step lag runs as a plain keyed window.
    lag = ordered.daily_lag_table(timefeatures.add_date_hour(load, ts), key, "Date", "Load", days=1,
                                  out="1DayLag", bucket_rows=None)
    df = joins.add_temperature(load, weather, ts, weather_ts, temp, check_unique=check_weather)
    df = clean.threshold_flags(df, "Temperature", hot, cold)
    df = timefeatures.add_date_hour(df, ts)
    df = timefeatures.add_time_features(df)
    df = ordered.rolling_features(df, key, ts, "Load", bucket_rows=bucket_rows)
    df = ordered.null_safe_join(df, lag, [key], plain=["Date"], how="left")
    df = timefeatures.add_numeric_date(df, ts)
    return df.select(key, ts, *[F.col(f"`{c}`") for c in FEATURE_COLUMNS])


def build_features_from_raw(raw: DataFrame, weather: DataFrame, *, key: str = "Name", **kw) -> DataFrame:
    """Landed load rows (``Time Stamp``, ``Time Zone``, ``Name``, ``PTID``, ``Integrated Load``) -> feature table."""
    load = to_utc(clean_load(raw))
    return build_features(load, weather, key=key, **kw)
