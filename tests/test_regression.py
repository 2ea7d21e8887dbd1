"""Walk-forward regression: every fold equals a least-squares refit on its own past."""

import datetime as dt
import random

import numpy as np
import pytest

from hourwise.operators import regression

SCHEMA = "series string, Date date, Load double"
START = dt.date(2023, 3, 1)


def _refit(data, days, extra, least):
    """Brute force: {(series, date): forecast}, a fit by numpy over all earlier folds."""
    at = {}
    for s, d, v in data:
        if v is not None and d is not None:
            at.setdefault((s, d), []).append(v)
    at = {k: sum(v) / len(v) for k, v in at.items()}
    rows = []
    for (s, d), y in at.items():
        x = [at.get((s, d - dt.timedelta(days=days + e))) for e in extra]
        if None not in x:
            rows.append((s, d, (d - dt.date(1970, 1, 1)).days // days, y, x))
    out = {}
    for s, d, fold, _, x in rows:
        past = [r for r in rows if r[0] == s and r[2] < fold]
        if len(past) < least:
            continue
        a = np.array([[1.0, *r[4]] for r in past])
        if np.linalg.matrix_rank(a - [0, *a[:, 1:].mean(axis=0)]) < a.shape[1]:
            continue
        fit = np.linalg.lstsq(a, np.array([r[3] for r in past]), rcond=None)[0]
        out[s, d] = float(fit @ [1.0, *x])
    return out


def _series(name, n, level, seed, gaps=True):
    r = random.Random(seed)
    return [(name, START + dt.timedelta(days=i), level + 10 * (i % 7) + r.gauss(0, 5)) for i in range(n) if not gaps or r.random() > 0.1]


@pytest.fixture(scope="module")
def data():
    flat = [("flat", START + dt.timedelta(days=i), 3.0) for i in range(90)]
    odd = [(None, START + dt.timedelta(days=3), None), ("a", None, 7.0), ("short", START, 1.0)]
    rows = _series("a", 120, 100.0, 1) + _series(None, 110, 1e6, 2) + _series("short", 12, 5.0, 3) + flat + odd
    return rows + [("a", START + dt.timedelta(days=50), 400.0)] * 2  # repeated rows: their mean counts


@pytest.mark.parametrize("extra", [(0,), (0, 7), (0, 1, 7)])
def test_every_fold_equals_a_refit_on_its_past(spark, data, extra):
    df = spark.createDataFrame(data, SCHEMA)
    got = regression.walk_forward_regression(df, "series", "Date", horizons={"day": 1, "week": 7}, extra_days=extra, min_train_rows=20).collect()
    for name, days in (("day", 1), ("week", 7)):
        mine = {(r.series, r.Date): r.forecast for r in got if r.horizon == name}
        want = _refit(data, days, extra, 20)
        assert mine.keys() == want.keys() and {s for s, _ in mine} == {"a", None}
        assert all(abs(mine[k] - want[k]) < 1e-6 * max(1.0, abs(want[k])) for k in want)


def test_flat_pasts_and_collinear_features_give_no_forecast(spark):
    line = [("line", START + dt.timedelta(days=i), float(i)) for i in range(80)]  # both lags differ by a constant
    flat = [("flat", START + dt.timedelta(days=i), 0.1) for i in range(80)]
    assert regression.walk_forward_regression(spark.createDataFrame(line + flat, SCHEMA), "series", "Date").count() == 0
    one = regression.walk_forward_regression(spark.createDataFrame(line + flat, SCHEMA), "series", "Date", extra_days=(0,)).collect()
    assert {r.series for r in one} == {"line"} and all(abs(r.forecast - r.actual) < 1e-9 for r in one)


def test_a_later_value_changes_no_earlier_forecast(spark, data):
    cut = START + dt.timedelta(days=80)
    df = spark.createDataFrame(data, SCHEMA)
    changed = spark.createDataFrame([(s, d, v if d is None or v is None or d < cut else v * 3) for s, d, v in data], SCHEMA)
    whole, other = ({(r.series, r.Date): r.forecast for r in regression.walk_forward_regression(x, "series", "Date", horizons={"day": 1}).collect()
                     if r.Date < cut} for x in (df, changed))
    assert len(whole) > 40 and whole.keys() == other.keys()
    assert all(abs(whole[k] - other[k]) < 1e-6 * abs(whole[k]) for k in whole)


def test_empty_and_compare(spark, data):
    empty = spark.createDataFrame([], SCHEMA)
    assert regression.walk_forward_regression(empty, "series", "Date").count() == 0
    f = regression.walk_forward_regression(spark.createDataFrame(data, SCHEMA), "series", "Date", horizons={"week": 7})
    got = {(r.series, r.model): r for r in regression.compare_models(f, ["series", "horizon"]).collect()}
    assert set(got) == {("a", "forecast"), ("a", "naive"), (None, "forecast"), (None, "naive")}
    assert got["a", "forecast"].n == got["a", "naive"].n and got["a", "forecast"].mae > 0


def test_rows_are_not_read_again_for_every_fold(spark, data):
    """The lagged rows are shuffled once by (series, horizon, time), however many lags there are: no self-join."""
    df = spark.createDataFrame(data, SCHEMA)
    plan = regression.lagged_rows(df, "series", "Date", extra_days=(0, 1, 2, 3, 7))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
