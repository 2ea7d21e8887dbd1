import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourwise.operators import ordered

ROLL_NULLS = [1, None, 3, 4, None, 6, 7, 8, 9, 10]


def _series(spark, values, key="a", start=dt.datetime(2024, 1, 1)):
    rows = [(key, start + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, Load double")


def _pandas_expected(values):
    s = pd.Series([np.nan if v is None else v for v in values], dtype=float)
    return {
        "LoadTrailing1": s.rolling(1, min_periods=1).mean(),
        "LoadTrailing2": s.rolling(2, min_periods=2).mean(),
        "LoadTrailing3": s.rolling(3, min_periods=1).mean(),
        "LoadTrailing7": s.rolling(7, min_periods=1).mean(),
        "LoadCentered3": s.rolling(3, center=True, min_periods=1).mean(),
        "LoadCentered7": s.rolling(7, center=True, min_periods=1).mean(),
    }


def _same(a, b):
    a, b = pd.Series(a, dtype=float), pd.Series(b, dtype=float)
    return bool(((a - b).abs().fillna(0) < 1e-9).all() and (a.isna() == b.isna()).all())


@pytest.mark.parametrize("bucket_rows", [None, 7, 100_000])
def test_rolling_features_match_pandas_with_nulls(spark, bucket_rows):
    out = ordered.rolling_features(_series(spark, ROLL_NULLS), "series", "Timestamp", "Load", bucket_rows=bucket_rows)
    got = out.orderBy("Timestamp").toPandas()
    for col, want in _pandas_expected(ROLL_NULLS).items():
        assert _same(got[col], want), col


def test_daily_lag_present_vs_calendar(spark):
    """missing_date: daily means 10, 20, 40 on 1, 2, 4 January."""
    rows = [("a", dt.date(2024, 1, d), float(v)) for d, v in ((1, 10), (2, 20), (4, 40))]
    df = spark.createDataFrame(rows, "series string, Date date, Load double")
    present = {r["Date"].day: r["lag"] for r in ordered.daily_lag_mean(df, "series", "Date", "Load", 1, "lag").collect()}
    cal = {r["Date"].day: r["lag"] for r in
           ordered.daily_lag_mean(df, "series", "Date", "Load", 1, "lag", mode="calendar").collect()}
    assert present == {1: None, 2: 10.0, 4: 20.0}
    assert cal == {1: None, 2: 10.0, 4: None}


def test_lead_target_drops_tail(spark):
    out = ordered.lead_target(_series(spark, list(range(10))), "series", "Timestamp", "Load", 7).orderBy("Timestamp")
    assert [r["Load_target"] for r in out.collect()] == [7.0, 8.0, 9.0]


def test_chrono_split_floor(spark):
    out = ordered.chrono_split(_series(spark, list(range(11))), "series", "Timestamp", 0.8)
    flags = [r["is_test"] for r in out.orderBy("Timestamp").collect()]
    assert flags == [False] * 8 + [True] * 3  # int(11 * 0.8) = 8


@settings(max_examples=12, deadline=None)
@given(
    lengths=st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=3),
    bucket=st.integers(min_value=7, max_value=20),
    gaps=st.integers(min_value=1, max_value=5),
)
def test_bucket_halo_equals_plain_window(spark, lengths, bucket, gaps):
    rows = []
    rng = np.random.default_rng(sum(lengths) + bucket)
    for k, n in enumerate(lengths):
        t = dt.datetime(2024, 1, 1)
        for i in range(n):
            t += dt.timedelta(hours=int(rng.integers(1, gaps + 1)))
            rows.append((f"s{k}", t, None if rng.random() < 0.1 else float(rng.integers(0, 100))))
    if not rows:
        return
    df = spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, Load double")
    cols = ["series", "Timestamp", "LoadTrailing2", "LoadTrailing7", "LoadCentered7"]
    plain = ordered.rolling_features(df, "series", "Timestamp", bucket_rows=None).select(*cols).toPandas()
    halo = ordered.rolling_features(df, "series", "Timestamp", bucket_rows=bucket).select(*cols).toPandas()
    plain = plain.sort_values(["series", "Timestamp"]).reset_index(drop=True)
    halo = halo.sort_values(["series", "Timestamp"]).reset_index(drop=True)
    assert len(plain) == len(halo) == len(rows)
    for c in cols[2:]:
        assert _same(plain[c], halo[c]), c


def test_series_index_dense_per_series(spark):
    df = _series(spark, list(range(50)), "a").unionByName(_series(spark, list(range(30)), "b"))
    idx = ordered.series_index(df, "series", "Timestamp", count_col="n").toPandas()
    for key, g in idx.groupby("series"):
        g = g.sort_values("Timestamp")
        assert list(g["_i"]) == list(range(len(g)))
        assert set(g["n"]) == {len(g)}


def test_sorted_index_global_and_grouped(spark):
    df = spark.range(0, 2000).withColumn("g", (F.col("id") % 3).cast("string")).withColumn("v", F.rand(7))
    out = ordered.sorted_index(df, ["v", "id"], index_col="gi", count_col="n").toPandas().sort_values(["v", "id"])
    assert list(out["gi"]) == list(range(2000)) and set(out["n"]) == {2000}
    grp = ordered.sorted_index(df, ["v", "id"], group=["g"], index_col="gi").toPandas()
    for _, g in grp.groupby("g"):
        assert list(g.sort_values(["v", "id"])["gi"]) == list(range(len(g)))


def test_bucket_window_plan_is_split_by_bucket(spark):
    out = ordered.rolling_features(_series(spark, list(range(20))), "series", "Timestamp", bucket_rows=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_wb" in plan and "hashpartitioning(series" in plan
