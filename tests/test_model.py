import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from hourwise.operators import encoding, metrics, model


def _synthetic(spark, hours=24 * 21, series=("a", "b")):
    rng = np.random.default_rng(0)
    rows = []
    for s in series:
        for i in range(hours):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
            load = 100 + 30 * math.sin(2 * math.pi * t.hour / 24) + (10 if t.weekday() >= 5 else 0) + rng.normal(0, 2)
            rows.append((s, t, t.hour, t.weekday(), float(load)))
    return spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, Hour int, Dow int, Load double")


def test_100_000_series_train_with_32_bins(spark):
    """The series key is one numeric feature: neither bins nor columns grow with the number of series."""
    df = spark.range(300_000).select(F.concat(F.lit("s"), F.col("id") % 100_000).alias("series"), F.col("id").cast("int").alias("n"),
                                     F.timestamp_add("DAY", (F.col("id") / 100_000).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("Timestamp"),
                                     (F.col("id") % 100_000 % 7).cast("double").alias("Load"))
    fitted = model.fit_gbt(df, "Load", [], max_iter=2, max_depth=3)
    assert fitted.gbt.getMaxBins() == 32 and fitted.gbt.numFeatures == 1
    assert model.predict(fitted, df.limit(1000)).count() == 1000


def test_key_means_are_of_the_past(spark):
    rng = np.random.default_rng(1)
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)), float(rng.normal()) if rng.random() < 0.9 else None)
            for k in ("a", "b", None) for h in rng.choice(24 * 8, 60, replace=False)]
    df = spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, y double")
    for gap in (0, 1):
        got = encoding.past_key_means(df, ["series"], "Timestamp", "y", "e", gap_days=gap, strength=3.0).collect()
        assert len(got) == len(rows)
        for r in got:
            old = [(k, y) for k, t, y in rows if y is not None and t.date() < r.Timestamp.date() - dt.timedelta(days=gap)]
            own = [y for k, y in old if k == r.series]
            want = (sum(own) + 3.0 * sum(y for _, y in old) / len(old)) / (len(own) + 3.0) if old else None
            assert (r.e is None) == (want is None) and (want is None or math.isclose(r.e, want, abs_tol=1e-9))
    means = encoding.key_means(df, ["series"], "y", "e")
    new = spark.createDataFrame([("a",), (None,), ("zz",)], "series string")
    got = {r.series: r.e for r in means.add(new).collect()}
    own = [y for k, _, y in rows if k is None and y is not None]
    assert math.isclose(got[None], (sum(own) + 10 * means.prior) / (len(own) + 10)) and math.isclose(got["zz"], means.prior)


def test_missing_values_have_an_indicator(spark):
    """The label depends on whether the feature is missing, which the imputed value alone cannot say."""
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), None if i % 3 == 0 else 5.0, 1, 10.0 if i % 3 == 0 else 0.0) for i in range(90)]
    df = spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, x double, z int, Load double")
    fitted = model.fit_gbt(df, "Load", ["x", "z"], key=None, max_iter=3, max_depth=2)
    assert fitted.missing == ["x"]
    assert all(abs(r.prediction - r.Load) < 1 for r in model.predict(fitted, df).collect())
    assert {r.feature: r.importance for r in model.importances(fitted, spark).collect()} == {"x": 1.0, "z": 0.0}


def test_training_stops_early(spark):
    df = _synthetic(spark, hours=24 * 10, series=("a",))
    train, valid = df.filter("Timestamp < '2024-01-08'"), df.filter("Timestamp >= '2024-01-08'").withColumn("Load", F.lit(0.0))
    fitted = model.fit_gbt_early_stop(train, valid, "Load", ["Hour"], max_iter=6, max_depth=2)
    assert fitted.n_trees == fitted.best_iteration < 6
    whole = model.fit_gbt_early_stop(train, train, "Load", ["Hour"], max_iter=6, max_depth=2, key=None)
    assert whole.n_trees == 6


def test_gbt_beats_seasonal_naive(spark):
    df = _synthetic(spark)
    df = df.withColumn("is_test", F.col("Timestamp") >= F.lit("2024-01-18").cast("timestamp_ntz"))
    fitted = model.fit_gbt_early_stop(df.filter("NOT is_test AND Timestamp < '2024-01-15'"),
                                      df.filter("NOT is_test AND Timestamp >= '2024-01-15'"),
                                      "Load", ["Hour", "Dow"], max_iter=30, max_depth=4)
    pred = model.predict(fitted, df.filter("is_test"))
    gbt = metrics.error_metrics(pred, "Load", "prediction").first()["rmse"]
    naive = metrics.error_metrics(metrics.seasonal_naive(df, "series", "Timestamp", "Load", 24).filter("is_test"),
                                  "Load", "forecast").first()["rmse"]
    assert fitted.n_trees <= 30 and gbt < naive
    imp = model.importances(fitted, spark).collect()
    assert {r["feature"] for r in imp} == {"Hour", "Dow", "series"}
