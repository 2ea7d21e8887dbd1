import datetime as dt

import pandas as pd
import pytz
from pyspark.sql import functions as F

from hourwise.functions import timefns as T
from hourwise.plans.features import to_utc


def _pytz_utc(local: dt.datetime, label: str) -> dt.datetime:
    eastern = pytz.timezone("US/Eastern")
    return eastern.localize(local, is_dst=(label == "EDT")).astimezone(pytz.UTC).replace(tzinfo=None)


def test_local_to_utc_matches_pytz_on_dst_edges(spark):
    """dst_edges: local times 00:30-03:30 around both changes in 2005 and 2024, each with EST and EDT."""
    days = [dt.date(2005, 4, 3), dt.date(2005, 10, 30), dt.date(2024, 3, 10), dt.date(2024, 11, 3),
            dt.date(2005, 7, 1), dt.date(2024, 1, 15)]
    rows = []
    for d in days:
        for minutes in range(30, 4 * 60, 30):
            local = dt.datetime.combine(d, dt.time()) + dt.timedelta(minutes=minutes)
            for label in ("EST", "EDT"):
                rows.append((local.strftime("%m/%d/%Y %H:%M:%S"), label, _pytz_utc(local, label)))
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "`Time Stamp` string, `Time Zone` string")
    got = to_utc(df.withColumn("k", F.monotonically_increasing_id()), out="utc")
    res = {r["k"]: r["utc"] for r in got.collect()}
    assert len(res) == len(rows)
    want = sorted(r[2] for r in rows)
    assert sorted(res.values()) == want


def test_local_to_utc_label_settles_repeated_hour(spark):
    df = spark.createDataFrame([("11/03/2024 01:30:00", "EDT"), ("11/03/2024 01:30:00", "EST")], "s string, l string")
    out = df.select(T.local_to_utc(T.parse_local("s"), "l").alias("u")).collect()
    assert [r["u"] for r in out] == [dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30)]


def test_calendar_fields_match_pandas(spark):
    dates = pd.date_range("2023-12-25", "2024-03-10", freq="D")
    df = spark.createDataFrame(pd.DataFrame({"d": dates.date}))
    out = df.select("d", T.day_name("d").alias("day"), T.is_weekend("d").alias("we"),
                    T.iso_day_of_week("d").alias("dow"), T.season_name(F.month("d")).alias("season")).toPandas()
    assert list(out["day"]) == list(dates.day_name())
    assert list(out["we"]) == list(dates.day_name().isin(["Saturday", "Sunday"]).astype(int))
    assert list(out["dow"]) == list(dates.weekday + 1)
    assert set(out["season"]) == {"Winter", "Spring"}


def test_format_and_parse(spark):
    df = spark.createDataFrame([("20010601",), ("20250401",)], "s string")
    out = df.select(T.compact_date("s").alias("d")).collect()
    assert [r["d"] for r in out] == [dt.date(2001, 6, 1), dt.date(2025, 4, 1)]
    bad = spark.createDataFrame([("13/45/2001 00:00:00",)], "s string").select(T.try_parse_local("s").alias("t")).collect()
    assert bad[0]["t"] is None
