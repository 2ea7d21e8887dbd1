"""Cases that once lost rows, failed or put most rows into one task."""

import datetime as dt
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from hourwise.functions import calendar as cal
from hourwise.operators import eda, fill, joins, metrics, monitor, ordered, quantiles, sampling
from hourwise.plans import collect
from hourwise.sources import files


def _new(name):
    return os.path.join(tempfile.mkdtemp(prefix="hw-reg-", dir="/tmp"), name)


def test_null_ids_keep_their_place_in_samples_and_splits(spark):
    df = spark.createDataFrame([(i if i % 10 else None, "a:b" if i % 3 else None, i) for i in range(1000)], "id long, other string, n long")
    split = sampling.hash_split(df, ["id", "other"], 0.2).collect()
    assert len(split) == 1000 and sum(r.is_test for r in split) == 200 and sorted(r.n for r in split) == list(range(1000))
    assert sampling.hash_sample(df, ["id"], 0.05).count() == 50
    assert sampling.hash_sample(df, ["id"], 0.0).count() == 0 and sampling.hash_sample(df, ["id"], 1.0).count() == 1000
    assert sampling.hash_split(df.limit(0), ["id"]).count() == 0
    two = spark.createDataFrame([("a", "b:c"), ("a:b", "c")], "x string, y string")
    assert two.select(sampling.hash_key(["x", "y"])).distinct().count() == 2


def test_two_deliveries_of_a_month_both_stay(spark):
    path = _new("months")
    rows = lambda zone, n: spark.createDataFrame([(zone, dt.datetime(2024, 1, 1, h), 1.0) for h in range(n)], "zone string, t timestamp_ntz, v double")
    for df in (rows("A", 5), rows("B", 5), rows("B", 5), rows(None, 2), rows(None, 2)):
        files.write_month_partitions(df, path, "t", keys=["zone", "t"])
    back = files.read_month_partitions(spark, path)
    assert {r.zone: r["count"] for r in back.groupBy("zone").count().collect()} == {"A": 5, "B": 5, None: 2}
    files.write_month_partitions(rows("C", 3), path, "t")  # without keys a delivery is the whole month
    assert files.read_month_partitions(spark, path).count() == 3


def test_collecting_two_zones_into_one_table(spark):
    land, target = _new("land"), _new("table")
    os.makedirs(land)
    lines = ["Time Stamp,Time Zone,Name,PTID,Integrated Load"] + [f"06/01/2001 0{h}:00:00,EDT,{z},1,{h}.5" for z in ("N.Y.C.", "WEST") for h in range(3)]
    with zipfile.ZipFile(f"{land}/20010601.zip", "w") as z:
        z.writestr("20010601.csv", "\n".join(lines) + "\n")
    for zone in ("N.Y.C.", "WEST", "WEST"):
        missing = collect.collect_archives(spark, f"{land}/*.zip", target, zone=zone, end="20010801")
    assert files.read_month_partitions(spark, target).groupBy("Name").count().orderBy("Name").collect() == [("N.Y.C.", 3), ("WEST", 3)]
    assert [r.partition for r in missing.orderBy("partition").collect()] == ["20010701", "20010801"]


def test_csv_with_doubled_quotes_and_line_breaks(spark):
    path = _new("q.csv")
    with open(path, "w") as f:
        f.write('a,b\n"x ""y"", z",1\n"two\nlines",2\n')
    assert [tuple(r) for r in files.read_csv(spark, path, "a string, b int", multi_line=True).collect()] == [('x "y", z', 1), ("two\nlines", 2)]
    df = spark.createDataFrame([('say ""', 1), ("a,b", 2)], "a string, b int")
    files.write_csv(df, (out := _new("csv")))
    assert sorted(map(tuple, files.read_csv(spark, out, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_an_outlier_leaves_no_hot_bucket(spark):
    """199,999 values beside one outlier: the chosen bucket is cut again until a task ranks few rows."""
    df = spark.range(200_000).select(F.when(F.col("id") == 7, F.lit(1e18)).otherwise(F.col("id") / 3).alias("v"))
    seen = []
    old, quantiles.RANKED_ROWS = quantiles.RANKED_ROWS, 5000
    original = quantiles._ranked_by_histogram

    def watched(*a, **k):
        seen.append(k.get("most") or 5000)
        return original(*a, **{**k, "most": 5000})

    quantiles._ranked_by_histogram = watched
    try:
        r = quantiles.grouped_quantiles(df, [], "v", [0.0, 0.5, 1.0], ["lo", "mid", "hi"]).first()
    finally:
        quantiles._ranked_by_histogram, quantiles.RANKED_ROWS = original, old
    values = sorted(1e18 if i == 7 else i / 3 for i in range(200_000))
    assert seen and (r.lo, r.hi) == (0.0, 1e18) and abs(r.mid - (values[99_999] + values[100_000]) / 2) < 1e-9


def test_quantiles_of_extreme_values(spark):
    df = spark.createDataFrame([(x,) for x in (-1.7e308, -1.0, 0.0, 1.0, 1.7e308)], "v double")
    r = quantiles.grouped_quantiles(df, [], "v", [0.25, 0.5, 0.75], ["a", "b", "c"], ).first()
    assert (r.a, r.b, r.c) == (-1.0, 0.0, 1.0)


def test_a_series_without_a_key_is_a_series(spark):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h % 24)) for k in (None, "a") for h in range(500) if (k, h) != (None, 100)]
    df = spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, Load double")
    same = lambda got: {k: n for k, n in got}
    assert same(joins.missing_hours(df, ["series"]).groupBy("series").count().collect()) == {None: 1}
    report = {r.series: (r.expected_hours, r.available_rows, r.missing_hours, r.first_missing) for r in joins.gap_report(df, ["series"]).collect()}
    assert report == {None: (500, 499, 1, [dt.datetime(2024, 1, 5, 4)]), "a": (500, 500, 0, None)}
    naive = metrics.seasonal_naive(df, "series", "Timestamp").filter("forecast IS NOT NULL").groupBy("series").count().collect()
    assert same(naive) == {None: 474, "a": 476}
    folds = metrics.walk_forward_folds(metrics.seasonal_naive(df, "series", "Timestamp"), "series", "Timestamp", "Load", "forecast")
    assert folds.filter("series IS NULL").count() == folds.filter("series = 'a'").count() == 20
    assert {r.series for r in monitor.drift(df, "series").collect()} == {None, "a"}
    assert {r.series for r in fill.fill_linear_single(df, "series").filter("is_filled").collect()} == {None}
    assert {r.series for r in fill.fill_pattern(df, "series").filter("is_filled").collect()} == {None}
    high = df.withColumn("Load", F.when(F.hour("Timestamp") + F.dayofmonth("Timestamp") == 1, 1000.0).otherwise(F.col("Load")))
    assert {r.series for r in eda.iqr_outliers(high, "series").collect()} == {None, "a"}
    assert ordered.calendar_lead(df, "series", "Timestamp").filter("series IS NULL AND Load_target IS NOT NULL").count() == 491
    daily = df.withColumn("Date", F.to_date("Timestamp"))
    assert ordered.daily_lag_mean(daily, "series", "Date").filter("series IS NULL AND `1DayLag` IS NOT NULL").count() == 475


def test_walk_forward_refit_uses_only_the_past(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(h // 24)) for h in range(24 * 21)]
    df = spark.createDataFrame(rows, "series string, Timestamp timestamp_ntz, Load double")
    got = {r.fold: r.mae for r in metrics.walk_forward_refit(df, "series", "Timestamp").collect()}
    assert got[dt.date(2024, 1, 8)] == 7.0 and got[dt.date(2024, 1, 15)] == 14 - 3.5 and len(got) == 14


def test_federal_rules_start_in_their_first_year(spark):
    days = spark.createDataFrame([(dt.date(*d),) for d in ((1980, 1, 21), (1986, 1, 20), (1950, 5, 29), (1971, 5, 31), (2020, 6, 19), (2021, 6, 19))], "d date")
    flags = cal.federal_holiday_flags("d")
    got = [tuple(r) for r in days.select(flags["martinLutherKingJrDay"], flags["memorialDay"], flags["juneteenthNationalIndependenceDay"]).collect()]
    assert got == [(0, 0, 0), (1, 0, 0), (0, 0, 0), (0, 1, 0), (0, 0, 0), (0, 0, 1)]


def test_unknown_report(spark):
    import pytest

    from hourwise.operators import profile

    with pytest.raises(ValueError, match="no such report"):
        profile.check_relevance(spark.range(1), "id", None, "pie")
