"""Forecast jobs (M7 and the random-split variant): features -> target -> split -> fit -> score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clean, metrics, model, ordered, sampling
from ..session import materialized


@dataclass
class ForecastResult:
    predictions: DataFrame   # test rows with ``prediction``
    metrics: DataFrame       # one row: n, mse, rmse, mae, mape, n_zero_actual
    fitted: model.Fitted


def as_of_split(features: DataFrame, as_of=None, *, key: str = "series", ts: str = "Timestamp", value: str = "Load",
                horizon: int = 7, train_fraction: float = 0.8) -> DataFrame:
    """Feature rows with the target ``horizon`` rows ahead, up to the date, split per series by position (``is_test``)."""
    df = ordered.lead_target(features, key, ts, value, horizon, f"{value}_target")
    if as_of is not None:
        df = clean.filter_as_of(df, "Date", as_of)
    return ordered.chrono_split(df, key, ts, train_fraction, "is_test")


def split_report(features: DataFrame, as_of=None, *, key: str = "series", value: str = "Load", valid_fraction: float = 0.1,
                 allow_non_causal: bool = False, **kw) -> DataFrame:
    """What a forecast as of a date is trained and tested on: (part, n, first_date, last_date, n_features) for the
    training part without its validation tail, the validation tail and the test part."""
    df = materialized(as_of_split(features, as_of, key=key, value=value, **kw), "split")
    n_features = len(model.feature_columns(df, f"{value}_target", exclude=[value], allow_non_causal=allow_non_causal))
    inner = ordered.chrono_split(df.filter(~F.col("is_test")), key, kw.get("ts", "Timestamp"), 1.0 - valid_fraction, "is_valid")
    parts = inner.select(F.when(F.col("is_valid"), "valid").otherwise("train").alias("part"), "Date").unionByName(
        df.filter("is_test").select(F.lit("test").alias("part"), "Date"))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
                                     F.lit(n_features).alias("n_features"))


def forecast_as_of(features: DataFrame, as_of=None, *, key: str = "series", ts: str = "Timestamp", value: str = "Load",
                   horizon: int = 7, train_fraction: float = 0.8, valid_fraction: float = 0.1, max_iter: int = 200,
                   max_depth: int = 6, tol: float = 0.0, allow_non_causal: bool = False,
                   validate_on_test: bool = False) -> ForecastResult:
    """M7: forecast ``horizon`` rows ahead as of a date.

    Rows with ``Date <= as_of`` (all rows when None) are split per series by
    position: the first ``train_fraction`` train, the rest test.  Early
    stopping validates on the tail ``valid_fraction`` of the training part
    (``validate_on_test=True`` uses the test part instead, as the original
    script did).  Non-causal columns are not features unless allowed.
    """
    target = f"{value}_target"
    df = materialized(as_of_split(features, as_of, key=key, ts=ts, value=value, horizon=horizon, train_fraction=train_fraction), "model-rows")
    train_all = df.filter(~F.col("is_test")).drop("is_test")
    test = df.filter(F.col("is_test")).drop("is_test")
    if validate_on_test:
        train, valid = train_all, test
    else:
        inner = ordered.chrono_split(train_all, key, ts, 1.0 - valid_fraction, "is_valid")
        train, valid = inner.filter(~F.col("is_valid")).drop("is_valid"), inner.filter(F.col("is_valid")).drop("is_valid")
    feats = model.feature_columns(df, target, exclude=[value], allow_non_causal=allow_non_causal)
    fitted = model.fit_gbt_early_stop(train, valid, target, feats, key=key, ts=ts, max_iter=max_iter, max_depth=max_depth, tol=tol)
    pred = model.predict(fitted, test)
    return ForecastResult(pred, metrics.error_metrics(pred, target, "prediction"), fitted)


def forecast_random_split(features: DataFrame, *, key: str = "series", ts: str = "Timestamp", value: str = "Load",
                          test_fraction: float = 0.2, seed: int = 42, mask_columns=("LoadRolling3",),
                          max_iter: int = 100, max_depth: int = 4, allow_non_causal: bool = False) -> ForecastResult:
    """The random-split variant: centred/trailing pair of width 3 added, seeded hash split, the look-ahead
    column blanked in the test part only (then imputed from the training median), 100 trees of depth 4.

    ``LoadTrailing1`` equals the target and the centred means contain it, so non-causal columns are features only
    with ``allow_non_causal=True`` (as in the original script)."""
    df = ordered.rolling_pair(features, key, ts, value, 3)
    df = sampling.hash_split(df, [key, ts], test_fraction, seed, "is_test")
    df = clean.mask_where(df, [c for c in mask_columns if c in df.columns], "is_test")
    feats = model.feature_columns(df, value, allow_non_causal=allow_non_causal)
    feats = [c for c in feats if c != "is_test"]
    df = materialized(df, "model-rows")  # trees, imputer and scoring read it again and again
    train, test = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
    fitted = model.fit_gbt(train, value, feats, key=key, ts=ts, max_iter=max_iter, max_depth=max_depth)
    pred = model.predict(fitted, test)
    return ForecastResult(pred, metrics.error_metrics(pred, value, "prediction"), fitted)
