import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from hourwise.functions import calendar as cal
from hourwise.functions import fixed_values as fv
from hourwise.operators import calendar_ops


def _dates(spark, start, end):
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("Date"))


def test_thanksgiving_matches_first_day_of_listed_breaks(spark):
    firsts = [dt.datetime.strptime(s, "%m/%d/%Y").date() for k, s, _ in fv.school_intervals() if k == "thanksgivingBreak"]
    years = spark.createDataFrame([(d.year,) for d in firsts], "y int")
    got = [r["t"] for r in years.select(cal.thanksgiving("y").alias("t")).orderBy("t").collect()]
    assert got == firsts
    text = years.select(cal.thanksgiving_text("y").alias("t")).orderBy("t").first()["t"]
    assert text == "2005-11-24"


def test_easter_rule_reproduces_listed_dates(spark):
    want = [dt.date.fromisoformat(d) for d in fv.date_list(fv.EASTER_DATES)]
    years = spark.createDataFrame([(d.year,) for d in want], "y int")
    got = [r["e"] for r in years.select(cal.easter_sunday("y").alias("e")).orderBy("e").collect()]
    assert got == want


def test_federal_rules_match_pandas_calendar(spark):
    from pandas.tseries.holiday import USFederalHolidayCalendar

    hol = USFederalHolidayCalendar().holidays("2005-01-01", "2025-12-31", return_name=True)
    df = calendar_ops.add_federal_holidays(_dates(spark, "2005-01-01", "2025-12-31")).toPandas()
    df["Date"] = pd.to_datetime(df["Date"])
    # pandas moves fixed-date holidays to the observed weekday; compare the floating (Monday/Thursday) ones exactly
    names = {"Birthday of Martin Luther King, Jr.": "martinLutherKingJrDay", "Washington's Birthday": "washingtonsBirthday",
             "Memorial Day": "memorialDay", "Labor Day": "laborDay", "Columbus Day": "columbusDay",
             "Thanksgiving Day": "thanksgivingDay"}
    for pname, col in names.items():
        want = set(hol[hol == pname].index)
        got = set(df.loc[df[col] == 1, "Date"])
        assert got == want, col
    assert set(df.loc[df["juneteenthNationalIndependenceDay"] == 1, "Date"].dt.year) == set(range(2021, 2026))


def test_observed_new_year_and_veterans(spark):
    df = calendar_ops.add_federal_holidays(_dates(spark, "2021-12-30", "2023-11-14")).toPandas().set_index("Date")
    assert df.loc[dt.date(2021, 12, 31), "newYearsDayObserved"] == 1  # 2022-01-01 is a Saturday
    assert df.loc[dt.date(2023, 1, 2), "newYearsDayObserved"] == 1    # 2023-01-01 is a Sunday
    assert df.loc[dt.date(2022, 11, 11), "veteransDay"] == 1
    assert df.loc[dt.date(2023, 11, 10), "veteransDayObserved"] == 1  # 2023-11-11 is a Saturday


def test_interval_flags_equal_between_join(spark):
    dates = _dates(spark, "2004-06-01", "2026-01-31")
    flagged = calendar_ops.add_school_flags(dates).toPandas().set_index("Date")
    iv = calendar_ops.school_calendar(spark)
    for kind in fv.BREAK_KINDS:
        between = (dates.join(iv.filter(F.col("kind") == kind), F.col("Date").between(F.col("start"), F.col("end")), "left_semi")
                   .toPandas())
        assert set(flagged.index[flagged[kind] == 1]) == set(between["Date"]), kind
    assert ((flagged["summerBreak"] + flagged["schoolYear"]) == 1).all()


def test_interval_join_plans_hash_join_not_nested_loop(spark):
    out = calendar_ops.add_school_flags(_dates(spark, "2010-01-01", "2010-12-31"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_event_dates_and_fixed(spark):
    df = calendar_ops.flag_event_dates(_dates(spark, "2024-02-01", "2024-02-29"), "Date", calendar_ops.super_bowl_dates(spark),
                                       ["superBowl"], row_bound=21)
    df = calendar_ops.add_fixed_date_holidays(df)
    pdf = df.toPandas().set_index("Date")
    assert pdf["superBowl"].sum() == 1 and pdf.loc[dt.date(2024, 2, 11), "superBowl"] == 1
    assert pdf.loc[dt.date(2024, 2, 14), "valentinesDay"] == 1 and pdf["valentinesDay"].sum() == 1


def test_rule_flags_need_no_join(spark):
    out = calendar_ops.add_holiday_features(_dates(spark, "2020-01-01", "2020-12-31"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    pdf = out.toPandas().set_index("Date")
    assert pdf.loc[dt.date(2020, 11, 26), ["thanksgiving", "thanksgivingDay"]].tolist() == [1, 1]
    assert pdf.loc[dt.date(2020, 11, 27), "blackFriday"] == 1 and pdf.loc[dt.date(2020, 11, 30), "cyberMonday"] == 1
    assert pdf.loc[dt.date(2020, 4, 12), "easter"] == 1 and pdf["easter"].sum() == 1
