import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hourwise.operators import metrics, profile, quantiles


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 500), "v": rng.normal(size=500)})
    pdf.loc[::37, "v"] = np.nan
    df = spark.createDataFrame(pdf)
    got = quantiles.grouped_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["q1", "q2", "q3"]).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].quantile([0.25, 0.5, 0.75]).unstack()
    for g in want.index:
        assert np.allclose(got.loc[g, ["q1", "q2", "q3"]].astype(float).values, want.loc[g].values)


def test_quantile_interpolation_small(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    r = quantiles.grouped_quantiles(df, [], "v", [0.25, 0.5]).first()
    assert math.isclose(r["q25"], 1.75) and math.isclose(r["q50"], 2.5)


def test_corr_constant_column_is_null_not_error(spark):
    """const_col: a constant column and a one-row table."""
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 2.0)], "a double, c double, b double")
    r = {(x["x"], x["y"]): x["r"] for x in profile.corr_matrix(df, ["a", "c", "b"]).collect()}
    assert r[("a", "c")] is None and r[("c", "c")] is None
    assert math.isclose(r[("a", "b")], 1.0)
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert profile.corr_matrix(one, ["a", "b"]).filter("x = 'a' AND y = 'b'").first()["r"] is None


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.normal(size=200), "y": rng.integers(0, 9, 200).astype(float)})
    got = profile.describe(spark.createDataFrame(pdf)).toPandas().set_index("column")
    want = pdf.describe().T
    for c in ("x", "y"):
        assert got.loc[c, "count"] == want.loc[c, "count"]
        for a, b in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
            assert math.isclose(got.loc[c, a], want.loc[c, b], rel_tol=1e-9, abs_tol=1e-12), (c, a)


def test_missing_and_value_counts_include_nan_and_null(spark):
    """nan_in: NaN counts as missing; value_counts keeps NULL as a group."""
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None), (2.0, "a")], "v double, s string")
    miss = {r["column"]: r["n_missing"] for r in profile.missing_profile(df).collect()}
    assert miss == {"v": 1, "s": 1}
    vc = profile.value_counts(df, "s").collect()
    assert [(r["s"], r["count"]) for r in vc] == [("a", 2), (None, 1)]


def test_describe_all_text_columns(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "s string, n int")
    out = profile.describe_all(df).toPandas().set_index("column")
    assert out.loc["s", "count"] == 3 and out.loc["s", "unique"] == 2 and out.loc["s", "top"] == "b" and out.loc["s", "freq"] == 2
    assert out.loc["n", "q50"] == 2.5


def test_error_metrics_skip_zero_actual(spark):
    """zero_actual: MAPE skips actual = 0 and counts it."""
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 8.0), (20.0, 25.0), (None, 3.0)], "a double, p double")
    r = metrics.error_metrics(df, "a", "p").first()
    assert r["n"] == 3 and r["n_zero_actual"] == 1
    assert math.isclose(r["mse"], (1 + 4 + 25) / 3) and math.isclose(r["mape"], (0.2 + 0.25) / 2 * 100)


def test_scale_by_count_uses_scalar_subquery(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    out = profile.scale_by_count(df, "v")
    assert [r["v_scaled"] for r in out.collect()] == [1 / 3, None, 1.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_shape_and_schema(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c double")
    assert profile.shape(df).first().asDict() == {"n_rows": 1, "n_cols": 3}
    sch = [(r["column"], r["type"], r["non_null"]) for r in profile.schema_table(df).orderBy("position").collect()]
    assert sch == [("a", "int", 1), ("b", "string", 1), ("c", "double", 0)]


def test_quantile_methods_agree_with_pandas_on_ties_and_groups(spark):
    import pytest as _pytest  # noqa: F401

    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b", "c", None], 3000),
        "v": np.concatenate([rng.integers(0, 5, 1500).astype(float), rng.lognormal(size=1500)]),
    })
    pdf.loc[::53, "v"] = np.nan
    pdf.loc[pdf["g"] == "c", "v"] = 7.0  # one group of a single repeated value
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = pdf.dropna(subset=["v"]).groupby("g", dropna=False)["v"].quantile(probs).unstack()
    for method, bins in (("histogram", 16), ("histogram", 1 << 14), ("sort", None)):
        kw = {"bins": bins} if bins else {}
        got = quantiles.grouped_quantiles(df, ["g"], "v", probs, [f"p{i}" for i in range(len(probs))],
                                          method=method, **kw).toPandas()
        for _, row in got.iterrows():
            key = row["g"] if row["g"] is not None else np.nan
            exp = want.loc[key] if key == key else want[want.index.isna()].iloc[0]
            assert np.allclose(row[[f"p{i}" for i in range(len(probs))]].astype(float).values, exp.values), (method, bins, key)


def test_corr_is_pairwise_complete_and_keeps_digits(spark):
    rng = np.random.default_rng(2)
    a = 1e9 + rng.normal(size=400)
    data = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=400), "c": rng.normal(size=400), "k": 7.0, "e": np.nan})
    for c, share in (("b", 0.3), ("c", 0.5), ("k", 0.2)):
        data.loc[rng.random(400) < share, c] = np.nan
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "a double, b double, c double, k double, e double").repartition(7)
    got = {(r.x, r.y): r.r for r in profile.corr_matrix(df).collect()}
    want = (data - data.median()).corr()  # exact differences: the library's own sums lose digits of large values
    assert len(got) == 25
    for (x, y), r in got.items():
        if "k" in (x, y) or "e" in (x, y):
            assert r is None
        else:
            assert abs(r - want.loc[x, y]) < 1e-9


def test_corr_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert {(r.x, r.y, r.r) for r in profile.corr_matrix(df).collect()} == {(x, y, None) for x in "ab" for y in "ab"}


def test_corr_in_chunks(spark, monkeypatch):
    df = spark.range(50).select(*[F.sin(F.col("id") * (i + 1)).alias(f"v{i}") for i in range(6)])
    whole = {(r.x, r.y): r.r for r in profile.corr_matrix(df).collect()}
    monkeypatch.setattr(profile, "CORR_CHUNK", 4)
    assert {(r.x, r.y): round(r.r, 9) for r in profile.corr_matrix(df).collect()} == {k: round(v, 9) for k, v in whole.items()} and len(whole) == 36


def test_distinct_counts_without_expand_and_by_sketches(spark):
    df = spark.range(20000).select((F.col("id") % 5).alias("m"), (F.col("id") % 3000).cast("string").alias("s"),
                                   F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0).alias("z"), F.array(F.col("id") % 4).alias("arr"), F.lit(None).cast("int").alias("none"))
    out = profile.nunique(df)
    assert {r["column"]: r["nunique"] for r in out.collect()} == {"m": 5, "s": 3000, "z": 1, "arr": 4, "none": 0}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    months = profile.sketches(df, ["s", "z", "none"], ["m"])
    merged = {r["column"]: r["nunique"] for r in profile.estimates(months).collect()}
    assert merged == {r["column"]: r["nunique"] for r in profile.nunique(df, ["s", "z", "none"], approx=True).collect()}
    assert merged["z"] == 1 and merged["none"] == 0 and abs(merged["s"] - 3000) < 150
    assert {r["m"]: r["nunique"] for r in profile.estimates(months.filter("column = 'z'"), ["m"]).collect()} == dict.fromkeys(range(5), 1)
