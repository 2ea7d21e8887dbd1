"""Walk-forward evaluation of a linear regression over several horizons (X9, M7): next day, next week, next month.

A fold is ``days`` consecutive days, counted from 1970-01-01.  Its model is the least-squares fit, with an intercept,
on all rows of the same series in earlier folds, and its features are values at least one horizon old, so everything
it uses is known when the fold begins.

No fold reads the rows again.  Rows are summed once per (series, horizon, fold): number, sums and products of features
and target.  A running sum over that small table -- one row a fold -- gives the normal equations of every past, and
each is solved by itself, in batches of numpy.  Sums are taken about the series' own means, so values far from zero
lose no digits; the fit does not depend on where the origin is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .metrics import error_metrics
from .ordered import _norm_keys, null_safe_join

HORIZONS = {"day": 1, "week": 7, "month": 30}
CONSTANT = 1e-12   # a feature whose variance is this share of its mean square says nothing
COLLINEAR = 1e-9   # smallest eigenvalue of the features' correlations that is still solved


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def lagged_rows(df: DataFrame, key: Sequence[str] | str, ts: str, value: str = "Load", *,
                horizons: Mapping[str, int] = HORIZONS, extra_days: Sequence[int] = (0, 7)) -> DataFrame:
    """(key..., horizon, ``ts``, y, x0, x1, ...): every value with the values of the same series ``days + extra`` days
    earlier at the same time, for every horizon.  Missing ones are NULL; several rows of one series and time count as
    their mean.

    One shuffle by (series, horizon, time) in place of a self-join for each lag: a value is sent to each time that
    needs it, and a series holding most rows is spread over its times."""
    keys = _keys(key)
    sent = [F.struct(F.lit(h).alias("horizon"), F.lit(slot).alias("slot"), F.lit(lag).alias("lag"))
            for h, days in horizons.items() for slot, lag in enumerate([0, *(days + e for e in extra_days)])]
    rows = df.select(*keys, F.col(ts).alias("_ts"), F.col(value).cast("double").alias("_v"), F.explode(F.array(*sent)).alias("_s"))
    rows = rows.filter(F.col("_ts").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v"))
    at = (F.col("_ts") + F.make_interval(days=F.col("_s.lag"))).cast(df.schema[ts].dataType)
    rows = rows.select(*keys, F.col("_s.horizon").alias("horizon"), at.alias(ts), F.col("_s.slot").alias("_slot"), "_v")
    slots = [F.avg(F.when(F.col("_slot") == i, F.col("_v"))).alias(n) for i, n in enumerate(["y", *(f"x{j}" for j in range(len(extra_days)))])]
    return rows.groupBy(*keys, "horizon", ts).agg(*slots).filter(F.col("y").isNotNull())


def _solver(p: int):
    """A vectorised function of (n, sums, products) to [intercept, slope...]; NULL where the past fixes no plane."""
    upper = np.triu_indices(p + 1)

    def solved(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean, square = sums / n[:, None], np.zeros((len(n), p + 1, p + 1))
        square[:, upper[0], upper[1]] = products / n[:, None]
        square[:, upper[1], upper[0]] = products / n[:, None]
        cov = square - mean[:, :, None] * mean[:, None, :]
        diagonal = np.arange(p)
        var = cov[:, diagonal, diagonal]
        ok = (var > CONSTANT * square[:, diagonal, diagonal]).all(axis=1)
        sd = np.sqrt(np.where(ok[:, None], var, 1.0))
        corr = np.where(ok[:, None, None], cov[:, :p, :p] / (sd[:, :, None] * sd[:, None, :]), np.eye(p))
        ok &= np.linalg.eigvalsh(corr)[:, 0] > COLLINEAR
        corr[~ok] = np.eye(p)
        slope = np.linalg.solve(corr, (cov[:, :p, p] / sd)[:, :, None])[:, :, 0] / sd
        return np.column_stack([mean[:, p] - (slope * mean[:, :p]).sum(axis=1), slope]), ok

    @F.pandas_udf("array<double>")
    def fit(n: pd.Series, sums: pd.Series, products: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(n), dtype=object)
        use = np.flatnonzero(n.fillna(0).to_numpy() > p)
        if len(use):
            got, ok = solved(n.to_numpy(dtype=float)[use], np.stack(sums.iloc[use].to_list()), np.stack(products.iloc[use].to_list()))
            for i, coefficients, good in zip(use, got, ok):
                out.iat[i] = coefficients if good else None
        return out

    return fit


def past_models(rows: DataFrame, key: Sequence[str] | str, ts: str, y: str, features: Sequence[str], fold: Column,
                min_train_rows: int) -> DataFrame:
    """(key..., _fold, n_train, _centre, _fit): for every fold the fit on the rows of the same key in earlier folds.

    ``_centre`` holds the key's means of the features and of ``y``, ``_fit`` the intercept and slopes about them; it is
    NULL with fewer than ``min_train_rows`` past rows, or where a feature is constant in them or a combination of others."""
    keys, z = _keys(key), [*features, y]
    whole = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in z)).withColumn("_fold", fold)
    centre = whole.groupBy(*keys).agg(F.array(*[F.avg(c) for c in z]).alias("_centre"))
    d = [F.col(c) - F.col("_centre")[i] for i, c in enumerate(z)]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = {f"_s{i}": F.sum(d[i]) for i in range(len(z))} | {f"_q{i}_{j}": F.sum(d[i] * d[j]) for i, j in pairs}
    folds = null_safe_join(whole, centre, keys).groupBy(*keys, "_fold").agg(
        F.first("_centre").alias("_centre"), F.count(F.lit(1)).alias("_n"), *[v.alias(k) for k, v in sums.items()])
    normed, own = _norm_keys(folds, keys)
    past = Window.partitionBy(*own).orderBy("_fold").rowsBetween(Window.unboundedPreceding, -1)  # one row a fold
    run = normed.select(*keys, "_fold", "_centre", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("n_train"),
                        F.array(*[F.sum(f"_s{i}").over(past) for i in range(len(z))]).alias("_s"),
                        F.array(*[F.sum(f"_q{i}_{j}").over(past) for i, j in pairs]).alias("_q"))
    # folds without a long enough past are dropped before the solver sees them; they give no forecast
    run = run.filter(F.col("n_train") >= max(min_train_rows, len(z)))
    return run.withColumn("_fit", _solver(len(features))("n_train", "_s", "_q")).drop("_s", "_q")


def walk_forward_regression(df: DataFrame, key: Sequence[str] | str, ts: str, value: str = "Load", *,
                            horizons: Mapping[str, int] = HORIZONS, extra_days: Sequence[int] = (0, 7),
                            min_train_rows: int = 30) -> DataFrame:
    """Forecasts of a regression refitted before every fold: (key..., horizon, ``ts``, fold, n_train, actual, naive,
    forecast).

    ``horizons`` maps names to numbers of days.  ``extra_days`` are the features: values of the same series this many
    days before the newest one known at the horizon; ``naive``, the first of them, is the baseline to beat.  A row
    without all features, in a fold whose past is shorter than ``min_train_rows`` or fixes no plane, has no forecast and
    is not returned."""
    keys = _keys(key)
    rows = materialized(lagged_rows(df, keys, ts, value, horizons=horizons, extra_days=extra_days), "lagged")
    features = [f"x{j}" for j in range(len(extra_days))]
    days = F.element_at(F.create_map(*[F.lit(v) for kv in horizons.items() for v in kv]), F.col("horizon"))
    fold = F.floor(F.unix_date(F.to_date(F.col(ts))) / days).cast("int")
    models = past_models(rows, [*keys, "horizon"], ts, "y", features, fold, min_train_rows).filter(F.col("_fit").isNotNull())
    scored = null_safe_join(rows.withColumn("_fold", fold), models, [*keys, "horizon"], plain=["_fold"])
    terms = [F.col("_fit")[j + 1] * (F.col(f) - F.col("_centre")[j]) for j, f in enumerate(features)]
    forecast = sum(terms, F.col("_centre")[len(features)] + F.col("_fit")[0])
    start = F.date_add(F.lit("1970-01-01").cast("date"), F.col("_fold") * days)
    out = scored.select(*keys, "horizon", ts, start.alias("fold"), "n_train", F.col("y").alias("actual"), F.col("x0").alias("naive"),
                        forecast.alias("forecast"))
    return out.filter(F.col("forecast").isNotNull())


def compare_models(forecasts: DataFrame, by: Sequence[str], models: Sequence[str] = ("forecast", "naive"), actual: str = "actual") -> DataFrame:
    """Error metrics of several forecast columns over the same rows: (by..., model, n, mse, rmse, mae, mape, n_zero_actual)."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("_p")) for m in models])).alias("_m")
    long = forecasts.select(*by, actual, each).select(*by, actual, "_m.model", "_m._p")
    return error_metrics(long, actual, "_p", [*by, "model"])
