"""Gap filling (X1, X2): rows are added for missing hours; present rows are never changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import missing_hours
from .ordered import null_safe_join


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fill_linear_single(df: DataFrame, key: Sequence[str] | str, ts: str = "Timestamp", value: str = "Load",
                       flag: str = "is_filled") -> DataFrame:
    """A missing hour whose previous and next hours are both present gets their mean (linear interpolation
    at the midpoint); longer gaps stay open.  Returns present rows plus filled rows."""
    keys = _keys(key)
    miss = missing_hours(df, keys, ts)
    hour = F.make_interval(hours=F.lit(1))
    prev = df.select(*keys, (F.col(ts) + hour).alias(ts), F.col(value).alias("_p"))
    nxt = df.select(*keys, (F.col(ts) - hour).alias(ts), F.col(value).alias("_n"))
    both = null_safe_join(null_safe_join(miss, prev, keys, plain=[ts]), nxt, keys, plain=[ts])
    filled = (both
              .filter(F.col("_p").isNotNull() & F.col("_n").isNotNull())
              .select(*keys, ts, ((F.col("_p") + F.col("_n")) / 2).alias(value)))
    present = df.select(*keys, ts, value)
    return present.withColumn(flag, F.lit(False)).unionByName(filled.withColumn(flag, F.lit(True)))


def fill_pattern(df: DataFrame, key: Sequence[str] | str, ts: str = "Timestamp", value: str = "Load",
                 flag: str = "is_filled") -> DataFrame:
    """A missing hour gets the series' mean for the same weekday and hour of day.

    The profile table has at most 168 rows per series, so the join is cheap.
    """
    keys = _keys(key)
    slot = [F.weekday(F.col(ts)).alias("_wd"), F.hour(F.col(ts)).alias("_hr")]
    profile = df.select(*keys, *slot, value).groupBy(*keys, "_wd", "_hr").agg(F.avg(value).alias(value))
    miss = missing_hours(df, keys, ts).select(*keys, ts, *slot)
    filled = null_safe_join(miss, profile, keys, plain=["_wd", "_hr"]).select(*keys, ts, value)
    present = df.select(*keys, ts, value)
    return present.withColumn(flag, F.lit(False)).unionByName(filled.withColumn(flag, F.lit(True)))
