"""Regression error metrics (A18) and simple forecasting baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import _norm_keys, null_safe_join


def error_metrics(df: DataFrame, actual: str, pred: str, group: Sequence[str] = ()) -> DataFrame:
    """n, MSE, RMSE, MAE, MAPE % per group over rows with both values present.

    MAPE skips rows whose actual value is 0 (where it is undefined) and
    reports how many it skipped in ``n_zero_actual``.
    """
    a, p = F.col(actual), F.col(pred)
    ok = df.filter(a.isNotNull() & p.isNotNull())
    e = a - p
    out = ok.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.avg(F.when(a != 0, F.abs(e / a))) * 100).alias("mape"),
        F.count_if(a == 0).alias("n_zero_actual"),
    )
    return out.withColumn("rmse", F.sqrt("mse")).select(*group, "n", "mse", "rmse", "mae", "mape", "n_zero_actual")


def seasonal_naive(df: DataFrame, key: Sequence[str] | str, ts: str, value: str = "Load", season_hours: int = 24,
                   out: str = "forecast") -> DataFrame:
    """Forecast = the value ``season_hours`` earlier of the same series (by time; NULL where absent)."""
    keys = [key] if isinstance(key, str) else list(key)
    past = df.select(*keys, (F.col(ts) + F.make_interval(hours=F.lit(season_hours))).alias(ts), F.col(value).alias(out))
    return null_safe_join(df, past, keys, plain=[ts], how="left")


def walk_forward_folds(df: DataFrame, key: Sequence[str] | str, ts: str, value: str, pred: str, fold: str = "day",
                       min_train_folds: int = 1) -> DataFrame:
    """Walk-forward evaluation: each period after the first ``min_train_folds`` is one test fold, scored
    with everything before it available; returns metrics per (series, fold)."""
    keys = [key] if isinstance(key, str) else list(key)
    f = F.date_trunc(fold, F.col(ts)).cast("timestamp_ntz")
    with_fold = df.withColumn("fold", f)
    bounds = with_fold.groupBy(*keys).agg(F.min("fold").alias("_first"))
    scored = null_safe_join(with_fold, bounds, keys).filter(
        F.col("fold") >= F.col("_first") + F.expr(f"INTERVAL {min_train_folds} {fold.upper()}")
    )
    return error_metrics(scored, value, pred, [*keys, "fold"])


def walk_forward_refit(df: DataFrame, key: Sequence[str] | str, ts: str, value: str = "Load", horizon_days: int = 1,
                       min_train_days: int = 7) -> DataFrame:
    """Walk-forward validation that refits (X9): before every fold of ``horizon_days`` days the profile model (mean by
    weekday and hour of the series) is fitted on all earlier days and scored on the fold; metrics per (series, fold).

    Fitting on a growing past is a running sum: rows are summed once per (series, weekday, hour, fold), and each
    fold's model is the sum over the folds before it -- a window over that small table, so no fold reads the rows
    again.  A slot never seen before its fold gives no forecast."""
    keys = [key] if isinstance(key, str) else list(key)
    t = F.col(ts)
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date"))
    rows = df.select(*keys, ts, value, F.weekday(t).alias("_wd"), F.hour(t).alias("_hr"), F.floor(day / horizon_days).cast("int").alias("_f"))
    normed, names = _norm_keys(rows.filter(F.col(value).isNotNull()), keys)
    slots = normed.groupBy(*keys, *names, "_wd", "_hr", "_f").agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    past = Window.partitionBy(*names, "_wd", "_hr").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    first = F.min("_f").over(Window.partitionBy(*names))
    fitted = slots.select(*keys, "_wd", "_hr", "_f", (F.sum("_s").over(past) / F.sum("_c").over(past)).alias("forecast"), first.alias("_first"))
    scored = null_safe_join(rows, fitted, keys, plain=["_wd", "_hr", "_f"])
    scored = scored.filter(F.col("_f") * horizon_days >= F.col("_first") * horizon_days + min_train_days)
    fold = F.date_add(F.lit("1970-01-01").cast("date"), F.col("_f") * horizon_days)
    return error_metrics(scored.withColumn("fold", fold), value, "forecast", [*keys, "fold"])
