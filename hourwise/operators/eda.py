"""Exploration of the series (X3-X5): outliers, seasonality, trend, autocorrelation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import DEFAULT_BUCKET_ROWS, lags as lag_columns, null_safe_join
from .profile import safe_corr
from .quantiles import grouped_quantiles


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def iqr_outliers(df: DataFrame, key, value: str = "Load", k: float = 1.5) -> DataFrame:
    """Rows outside ``[q1 - k*iqr, q3 + k*iqr]`` of their series (exact quartiles), with the fences."""
    keys = _keys(key)
    q = grouped_quantiles(df, keys, value, [0.25, 0.75], ["q1", "q3"])
    fences = q.select(*keys, (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
                      (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))
    j = null_safe_join(df, fences, keys)
    return j.filter((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")))


def seasonality(df: DataFrame, key, ts: str = "Timestamp", value: str = "Load") -> DataFrame:
    """Mean per (series, period, slot) for period hour (0-23), weekday (1=Mon..7) and month (1-12),
    in one shuffle: each row is tagged with its three slots, then aggregated once."""
    keys = _keys(key)
    t = F.col(ts)
    slots = F.array(
        F.struct(F.lit("hour").alias("period"), F.hour(t).alias("slot")),
        F.struct(F.lit("weekday").alias("period"), (F.weekday(t) + 1).alias("slot")),
        F.struct(F.lit("month").alias("period"), F.month(t).alias("slot")),
    )
    tagged = df.select(*keys, value, F.explode(slots).alias("_s")).select(*keys, "_s.period", "_s.slot", value)
    return tagged.groupBy(*keys, "period", "slot").agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n"))


def trend(df: DataFrame, key, ts: str = "Timestamp", value: str = "Load", origin: str = "2000-01-01") -> DataFrame:
    """Least-squares slope per day and intercept of ``value`` over time, per series."""
    keys = _keys(key)
    x = F.timestamp_diff("HOUR", F.lit(origin).cast("timestamp_ntz"), F.col(ts)).cast("double")
    return df.groupBy(*keys).agg(
        (F.regr_slope(F.col(value), x) * 24).alias("slope_per_day"),
        F.regr_intercept(F.col(value), x).alias("intercept"),
        F.regr_count(F.col(value), x).alias("n"),
    )


def autocorrelation(df: DataFrame, key, ts: str = "Timestamp", value: str = "Load", lags: Sequence[int] = (1, 2, 3, 6, 12, 24),
                    *, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Pearson correlation of the series with itself k *rows* earlier, per series and lag (where hours are
    missing, a row lag spans more than k hours; fill gaps first for a lag in hours)."""
    keys = _keys(key)
    lagged = lag_columns(df.select(*keys, ts, value), keys, ts, value, lags, bucket_rows=bucket_rows)
    stack = ", ".join(f"{k}, `{value}Lag{k}`" for k in lags)
    long = lagged.selectExpr(*[f"`{k}`" for k in keys], f"`{value}`", f"stack({len(lags)}, {stack}) AS (lag, _lagged)")
    return long.groupBy(*keys, "lag").agg(safe_corr(F.col(value), F.col("_lagged")).alias("acf"))
