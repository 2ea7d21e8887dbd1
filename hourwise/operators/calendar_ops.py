"""Calendar flags per date (C1-C9) and the date-set joins behind them.

Rule-based flags (holidays, Thanksgiving family, Easter, fixed days) are
column expressions evaluated per row: no lookup table, no join, no shuffle.
Listed dates and intervals (events, school calendar) are joined as a small
date -> flags dimension whose size is bounded by the list itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions import calendar as cal
from ..functions import fixed_values as fv
from ..session import broadcast_if_bounded

INTERVAL_SCHEMA = StructType([StructField("kind", StringType()), StructField("start", DateType()), StructField("end", DateType())])
EVENT_SCHEMA = StructType([StructField("name", StringType()), StructField("d", DateType())])


def school_calendar(spark: SparkSession) -> DataFrame:
    """The fixed school calendar as ``intervals(kind, start, end)``, both ends inclusive."""
    rows = [(k, s, e) for k, s, e in fv.school_intervals()]
    df = spark.createDataFrame(rows, "kind string, s string, e string")
    return df.select("kind", F.to_date("s", "MM/dd/yyyy").alias("start"), F.to_date("e", "MM/dd/yyyy").alias("end"))


def super_bowl_dates(spark: SparkSession) -> DataFrame:
    """The fixed Super Bowl list as ``event_dates(name='superBowl', d)``."""
    return spark.createDataFrame([("superBowl", d) for d in fv.date_list(fv.SUPER_BOWL_DATES)], "name string, d string").select(
        "name", F.to_date("d").alias("d")
    )


def _flag_from_dimension(df: DataFrame, date_col: str, dim: DataFrame, names: Sequence[str], row_bound: int | None) -> DataFrame:
    """Left-join a (d, name) membership table pivoted to one 0/1 column per name; absent -> 0."""
    wide = dim.groupBy("d").agg(*[F.max((F.col("name") == n).cast("int")).alias(n) for n in names])
    wide = broadcast_if_bounded(wide, row_bound) if row_bound is not None else wide
    out = df.join(wide.withColumnRenamed("d", "__d"), F.col(date_col) == F.col("__d"), "left").drop("__d")
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in names})


def flag_event_dates(df: DataFrame, date_col: str, events: DataFrame, names: Sequence[str], *,
                     row_bound: int | None = None) -> DataFrame:
    """One 0/1 column per event ``name``: is the row's date in that name's date list.

    ``row_bound``: a proven upper bound on the number of listed dates; when it
    is small the list is broadcast, otherwise Spark/AQE pick the join.
    """
    return _flag_from_dimension(df, date_col, events.select("name", "d").distinct(), names, row_bound)


def expand_intervals(intervals: DataFrame) -> DataFrame:
    """(kind, start, end) -> distinct (name=kind, d) for every day of every interval (inclusive)."""
    return intervals.select(F.col("kind").alias("name"), F.explode(F.sequence("start", "end")).alias("d")).distinct()


def flag_intervals(df: DataFrame, date_col: str, intervals: DataFrame, kinds: Sequence[str], *,
                   row_bound: int | None = None) -> DataFrame:
    """One 0/1 column per interval kind: ``start <= date <= end`` for any interval of that kind.

    The range condition is turned into an equi-join by expanding intervals to
    days (a direct BETWEEN join plans a nested loop).  ``row_bound`` bounds the
    number of expanded days; below the broadcast limit the dimension is
    broadcast.
    """
    return _flag_from_dimension(df, date_col, expand_intervals(intervals), kinds, row_bound)


def school_flag_bound() -> int:
    """Upper bound on the expanded school calendar: total days over all listed intervals."""
    import datetime as dt

    fmt = "%m/%d/%Y"
    return sum((dt.datetime.strptime(e, fmt) - dt.datetime.strptime(s, fmt)).days + 1 for _, s, e in fv.school_intervals())


def add_school_flags(df: DataFrame, date_col: str = "Date", intervals: DataFrame | None = None) -> DataFrame:
    """summerBreak, schoolYear, winterBreak, midWinterBreak, springBreak, thanksgivingBreak.

    summerBreak = 1 - schoolYear, so dates outside every listed school year
    (also before the first) count as summer.
    """
    spark = df.sparkSession
    iv = intervals if intervals is not None else school_calendar(spark)
    bound = school_flag_bound() if intervals is None else None
    out = flag_intervals(df, date_col, iv, fv.BREAK_KINDS, row_bound=bound)
    out = out.withColumn("summerBreak", F.lit(1) - F.col("schoolYear"))
    rest = [c for c in out.columns if c not in ("summerBreak", *fv.BREAK_KINDS)]
    return out.select(*[F.col(f"`{c}`") for c in rest], "summerBreak", "schoolYear", "winterBreak", "midWinterBreak",
                      "springBreak", "thanksgivingBreak")


def add_federal_holidays(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Thirteen federal holiday flags by rule."""
    return df.withColumns(cal.federal_holiday_flags(date_col))


def add_fixed_date_holidays(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """C4: newYearsEve, christmasEve, valentinesDay, halloween."""
    return df.withColumns(cal.fixed_date_flags(date_col))


def add_thanksgiving_family(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Thanksgiving, blackFriday, cyberMonday (years come from the data itself)."""
    return df.withColumns(cal.thanksgiving_family_flags(date_col))


def add_easter(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Easter Sunday flag (Gregorian computus)."""
    return df.withColumn("easter", cal.easter_flag(date_col))


def add_holiday_features(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """All holiday groups in order: federal, fixed dates, Thanksgiving family, Easter -- one projection."""
    exprs = {}
    exprs.update(cal.federal_holiday_flags(date_col))
    exprs.update(cal.fixed_date_flags(date_col))
    exprs.update(cal.thanksgiving_family_flags(date_col))
    exprs["easter"] = cal.easter_flag(date_col)
    return df.withColumns(exprs)
