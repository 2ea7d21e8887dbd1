"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the provided tables.

Stand-ins (see FIXTURES.md): ``events`` aggregated per hour and event type is
the demand series; its 'view' series is the weather; ``orders`` dates shifted
by 20 years drive the calendar operators.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.timefns import local_to_utc, parse_local
from ..operators import (calendar_ops, clean, eda, fill, joins, metrics, monitor, ordered, profile, regression,
                         sampling, thresholds, timefeatures)
from ..plans import calendar_features, features, forecast
from ..session import scratch_path
from ..sources import files, zips
from . import common as C

Query = Callable[[SparkSession, str], DataFrame]
KEY = "series"
TS = "Timestamp"


def _h(spark, sf, *, reused: bool = True):
    """The hourly series; materialised once when the query reads it more than once."""
    return C.hourly(spark, sf, materialize=reused)


# --------------------------------------------------------------------------- sources and sinks

def src_csv_roundtrip(spark, sf):
    cust = C.table(spark, sf, "customer")
    path = scratch_path(spark, "customer_csv")
    files.write_csv(cust, path)
    return C.rounded(files.read_csv(spark, path, cust.schema))


def sink_overwrite(spark, sf):
    orders = C.table(spark, sf, "orders")
    path = scratch_path(spark, "orders_parquet")
    files.write_table(orders, path)
    files.write_table(orders, path)  # overwrite: the second write replaces the first
    return C.rounded(spark.read.parquet(path))


def src_month_partitions(spark, sf):
    o = C.table(spark, sf, "orders")
    bounds = o.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    months = files.month_partitions(bounds)
    counts = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month_start")).agg(F.count(F.lit(1)).alias("n_orders"))
    return months.join(counts, "month_start", "left").select(
        "partition", "month_start", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


def sink_append_month(spark, sf):
    o = C.table(spark, sf, "orders")
    path = scratch_path(spark, "orders_by_month")
    files.write_month_partitions(o, path, "o_orderdate")
    files.write_month_partitions(o, path, "o_orderdate")  # re-run of the same months: replaced, not appended
    back = files.read_month_partitions(spark, path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def sink_merge_month(spark, sf):
    """S4 keyed: two zones of every month are delivered one after the other; the first zone's year 1996 is delivered
    again with new prices, one row of it twice with different prices (the greater stays)."""
    o = C.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    path = scratch_path(spark, "orders_merged")
    kw = dict(ts="o_orderdate", keys=["o_orderkey", "o_orderstatus"], order=["o_totalprice"])
    first, rest = o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus != 'F' OR o_orderstatus IS NULL")
    files.write_month_partitions(first, path, **kw)
    files.write_month_partitions(rest, path, **kw)
    files.write_month_partitions(rest, path, **kw)  # a repeated delivery changes nothing
    again = first.filter(F.year("o_orderdate") == 1996)
    raised = again.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    files.write_month_partitions(raised.unionByName(again), path, **kw)
    return C.rounded(files.read_month_partitions(spark, path).select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice", "month"))


def src_zip_ingest(spark, sf):
    """The orders landed as one archive a month with one CSV member a status, read back by member."""
    o = C.table(spark, sf, "orders")
    land = scratch_path(spark, "orders_zip")
    cols = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    zips.write_zip_csv(o.select(*cols, F.date_format("o_orderdate", "yyyyMM").alias("a"), F.concat_ws("-", F.lit("orders"), "o_orderstatus").alias("m")), land, "a", "m")
    rows = zips.read_zip_csv(spark, f"{land}/*.zip", o.select(*cols).schema)
    name = F.regexp_extract("source_member", r"([0-9]+)\.zip!(.*)$", 1), F.regexp_extract("source_member", r"([0-9]+)\.zip!(.*)$", 2)
    return C.rounded(rows.select(*cols, name[0].alias("archive"), name[1].alias("member")))


def pipe_collect(spark, sf):
    """Monthly archives of the orders, without those of June, collected into month partitions; the months missing."""
    from ..plans import collect

    o = C.table(spark, sf, "orders").filter((F.month("o_orderdate") != 6) & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
    land, target = (scratch_path(spark, n) for n in ("archives", "collected"))
    raw = o.select(F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss").alias("Time Stamp"), F.lit("EST").alias("Time Zone"), F.col("o_orderpriority").alias("Name"),
                   F.col("o_orderkey").cast("string").alias("PTID"), F.col("o_totalprice").alias("Integrated Load"),
                   F.date_format("o_orderdate", "yyyyMM01").alias("a"), F.date_format("o_orderdate", "yyyyMMdd").alias("m"))
    zips.write_zip_csv(raw.withColumn("m", F.substring("m", 1, 7)), land, "a", "m")
    return collect.collect_archives(spark, f"{land}/*.zip", target, start="19950101", end="20010301")


def set_union_months(spark, sf):
    o = C.table(spark, sf, "orders")
    path = scratch_path(spark, "orders_months")
    files.write_month_partitions(o, path, "o_orderdate")
    early = files.read_month_partitions(spark, path).filter(F.col("month") < "1998")
    late = files.read_month_partitions(spark, path).filter(F.col("month") >= "1998")
    return C.rounded(files.union_frames([early, late]).drop("month"))


def src_time_range_scan(spark, sf):
    return C.rounded(files.time_range_scan(spark, os.path.join(sf, "events.parquet"), "ts",
                                           "2024-01-05 00:00:00", "2024-01-20 23:59:59.999999"))


# --------------------------------------------------------------------------- projections and filters

def flt_asof_date(spark, sf):
    e = C.table(spark, sf, "events").withColumn("Date", F.to_date("ts"))
    return C.rounded(clean.filter_as_of(e, "Date", "2024-01-20").drop("Date"))


def str_incremental_ingest(spark, sf):
    """X11: orders landed as two overlapping drops (from 1997, then the late ones up to 1997), ingested incrementally:
    every order arrives exactly once, however late."""
    from ..streaming.ingest import run_once

    o = C.table(spark, sf, "orders")
    land, target, ck = (scratch_path(spark, n) for n in ("landing", "ingested", "ingest_ck"))
    kw = dict(keys=["o_orderkey"], ts="o_orderdate", fmt="parquet")
    o.filter(F.year("o_orderdate") >= 1997).write.mode("overwrite").parquet(f"{land}/drop=1")
    run_once(spark, land + "/drop=*", o.schema, target, ck, **kw)
    o.filter(F.year("o_orderdate") <= 1997).write.mode("overwrite").parquet(f"{land}/drop=2")
    run_once(spark, land + "/drop=*", o.schema, target, ck, **kw)
    return C.rounded(spark.read.parquet(target).drop("month"))


def flt_zone_eq(spark, sf):
    return C.rounded(clean.filter_equals(C.table(spark, sf, "events"), "event_type", "click"))


def _events_with_nulls(spark, sf):
    # Every 20th event's value blanked to exercise NULL handling (the tables have no NULLs).
    e = C.table(spark, sf, "events")
    return e.withColumn("value", F.when(F.col("event_id") % 20 == 0, F.lit(None)).otherwise(F.col("value")))


def flt_dropna(spark, sf):
    return C.rounded(clean.drop_missing(_events_with_nulls(spark, sf), ["value"]))


def prj_drop_rename(spark, sf):
    c = C.table(spark, sf, "customer")
    return C.rounded(clean.drop_and_rename(c, ["c_name"], {"c_acctbal": "balance", "c_mktsegment": "segment"}))


def prj_numeric_cols(spark, sf):
    li = C.table(spark, sf, "lineitem")
    return C.rounded(clean.select_numeric(li, exclude=["l_orderkey"]))


def prj_threshold_flags(spark, sf):
    return C.rounded(clean.threshold_flags(C.weather(spark, sf, C.hourly(spark, sf, materialize=False)), "temp", 20.0, 9.0))


def prj_mask_leaky(spark, sf):
    h = ordered.rolling_pair(_h(spark, sf), KEY, TS, "Load", 3)
    h = ordered.chrono_split(h, KEY, TS, 0.8, "is_test")
    return C.rounded(clean.mask_where(h, ["LoadRolling3"], "is_test"))


def prj_cast(spark, sf):
    o = C.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    o = o.withColumns({
        "order_date": F.col("o_orderdate"),
        "order_text": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "is_finished": F.col("o_orderstatus") == "F",
        "price_cents": F.round(F.col("o_totalprice") * 100),
    })
    o = o.withColumn("order_ts", F.col("order_text"))
    o = clean.cast_columns(o, {"order_date": "date", "is_finished": "int", "price_cents": "long", "order_ts": "timestamp_ntz"})
    return o.select("o_orderkey", "order_date", "order_text", "order_ts", "is_finished", "price_cents")


# --------------------------------------------------------------------------- date / time

def _local_orders(spark, sf):
    # Local wall time: order date plus an hour of day taken from the order key; label EDT for April-October.
    o = C.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    local = F.col("o_orderdate") + F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return o.select("o_orderkey", F.date_format(local, "MM/dd/yyyy HH:mm:ss").alias("local_text"),
                    F.when(F.month("o_orderdate").between(4, 10), "EDT").otherwise("EST").alias("label"))


def ts_local_to_utc(spark, sf):
    o = _local_orders(spark, sf)
    utc = local_to_utc(parse_local("local_text"), "label")
    return o.withColumn("utc", utc).withColumn("utc_text", F.date_format("utc", "yyyy-MM-dd HH:mm:ss"))


def ts_format(spark, sf):
    e = C.table(spark, sf, "events").select("event_id", "ts")
    e = timefeatures.format_timestamp(e, "ts", "ts_text")
    return e.select("event_id", "ts_text", F.date_format("ts", "yyyy-MM-dd").alias("date_text"))


def ts_date_hour(spark, sf):
    e = C.table(spark, sf, "events").select("event_id", "ts")
    return timefeatures.add_date_hour(e, "ts").drop("ts")


def ts_calendar_fields(spark, sf):
    o = C.calendar_orders(spark, sf).select("o_orderkey", "Date")
    return timefeatures.add_time_features(o)


def ts_numeric_date(spark, sf):
    o = C.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return timefeatures.add_numeric_date(o, "o_orderdate").drop("o_orderdate")


def ts_cyclical(spark, sf):
    return C.rounded(timefeatures.add_cyclical(_h(spark, sf, reused=False).drop("Load"), TS))


# --------------------------------------------------------------------------- calendar

def _cal(spark, sf):
    return C.calendar_orders(spark, sf).select("o_orderkey", "Date")


def cal_nth_weekday(spark, sf):
    y = _cal(spark, sf).select(F.year("Date").alias("Year")).distinct()
    return y.select(
        "Year",
        cal.thanksgiving_text("Year").alias("thanksgiving"),
        cal.nth_weekday(F.col("Year"), 1, cal.MON, 3).alias("mlk_day"),
        cal.nth_weekday(F.col("Year"), 9, cal.MON, 1).alias("labor_day"),
        cal.last_weekday(F.col("Year"), 5, cal.MON).alias("memorial_day"),
    )


def cal_thanksgiving_family(spark, sf):
    return calendar_ops.add_thanksgiving_family(_cal(spark, sf))


def cal_federal_flags(spark, sf):
    return calendar_ops.add_federal_holidays(_cal(spark, sf))


def cal_fixed_dates(spark, sf):
    return calendar_ops.add_fixed_date_holidays(_cal(spark, sf))


def cal_easter(spark, sf):
    return calendar_ops.add_easter(_cal(spark, sf))


def cal_event_dates(spark, sf):
    from ..functions import fixed_values as fv
    return calendar_ops.flag_event_dates(_cal(spark, sf), "Date", calendar_ops.super_bowl_dates(spark), ["superBowl"],
                                         row_bound=len(fv.date_list(fv.SUPER_BOWL_DATES)))


def cal_interval_flags(spark, sf):
    return calendar_ops.add_school_flags(_cal(spark, sf))


def pipe_calendar_features(spark, sf):
    o = C.calendar_orders(spark, sf).select(
        "o_orderkey", F.col("o_totalprice").alias("Load"), F.col("Date").cast("timestamp_ntz").alias(TS))
    return C.rounded(calendar_features.build_calendar_features(o, TS, keep=["o_orderkey"]))


# --------------------------------------------------------------------------- joins, gaps, sets

def join_left_temperature(spark, sf):
    h = _h(spark, sf)
    return C.rounded(joins.add_temperature(h, C.weather(spark, sf, h), TS, TS, "temp"))


def dq_missing_hours(spark, sf):
    return joins.missing_hours(_h(spark, sf), [KEY], TS)


def dq_gap_report(spark, sf):
    r = joins.gap_report(_h(spark, sf), [KEY], TS)
    text = F.array_join(F.transform("first_missing", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")), ",")
    return r.withColumn("first_missing", text)


def set_except_hours(spark, sf):
    return joins.except_hours(_h(spark, sf), [KEY], TS)


# --------------------------------------------------------------------------- aggregates and profiles

def agg_category_mean(spark, sf):
    o = timefeatures.add_time_features(C.calendar_orders(spark, sf).select("Date", F.col("o_totalprice").alias("Load")))
    return C.rounded(profile.category_mean(o, "Day", "Load", "mean_Load"), 4)


def agg_onehot_counts(spark, sf):
    return profile.onehot_counts(C.table(spark, sf, "labels"), ["quality", "toxic"])


def agg_cond_mean(spark, sf):
    docs = C.table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = C.table(spark, sf, "labels").select("doc_id", "quality")
    return C.rounded(profile.cond_mean(docs.join(lab, "doc_id"), "quality", "n_chars"))


def agg_time_span(spark, sf):
    return profile.time_span(C.table(spark, sf, "events"), "ts", ["event_type"])


def agg_scale_by_count(spark, sf):
    return C.rounded(profile.scale_by_count(_h(spark, sf), "Load"))


def _lineitem_with_missing(spark, sf):
    # A zero discount read as "no discount recorded" gives the profile real missing values.
    li = C.table(spark, sf, "lineitem")
    return li.withColumn("l_discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))


def prof_missing(spark, sf):
    return C.rounded(profile.missing_profile(_lineitem_with_missing(spark, sf)))


def prof_shape(spark, sf):
    return profile.shape(C.table(spark, sf, "lineitem"))


def prof_schema(spark, sf):
    return profile.schema_table(C.table(spark, sf, "customer"))


def prof_nunique(spark, sf):
    return profile.nunique(C.table(spark, sf, "customer"))


def prof_value_counts(spark, sf):
    return profile.value_counts(C.table(spark, sf, "customer"), "c_mktsegment")


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def prof_moments(spark, sf):
    return C.rounded(profile.moments(_lineitem_with_missing(spark, sf), LI_NUM), 4)


def prof_describe(spark, sf):
    return C.rounded(profile.describe(_lineitem_with_missing(spark, sf), LI_NUM), 4)


def prof_describe_all(spark, sf):
    return C.rounded(profile.describe_all(C.table(spark, sf, "customer")), 4)


def prof_corr_matrix(spark, sf):
    return C.rounded(profile.corr_matrix(_lineitem_with_missing(spark, sf), LI_NUM + ["l_linenumber"]))


# --------------------------------------------------------------------------- windows, order, limits

def win_trailing_mean(spark, sf):
    return C.rounded(ordered.trailing_means(_h(spark, sf), KEY, TS, "Load"))


def win_centered_mean(spark, sf):
    return C.rounded(ordered.centered_means(_h(spark, sf), KEY, TS, "Load"))


def win_rolling_pair(spark, sf):
    return C.rounded(ordered.rolling_pair(_h(spark, sf), KEY, TS, "Load", 3))


def win_lead_target(spark, sf):
    return C.rounded(ordered.lead_target(_h(spark, sf), KEY, TS, "Load", 7))


def win_calendar_lead(spark, sf):
    return C.rounded(ordered.calendar_lead(_h(spark, sf), KEY, TS, "Load", 7))


def win_daily_lag_mean(spark, sf):
    h = timefeatures.add_date_hour(_h(spark, sf), TS).drop("Hour")
    return C.rounded(ordered.daily_lag_mean(h, KEY, "Date", "Load", 1, "1DayLag"))


def win_chrono_split(spark, sf):
    return C.rounded(ordered.chrono_split(_h(spark, sf), KEY, TS, 0.8, "is_test"))


def win_position_slice(spark, sf):
    return C.rounded(ordered.position_slice(_h(spark, sf), KEY, TS, 100, 200, index_col="position"))


def win_lags(spark, sf):
    return C.rounded(ordered.lags(_h(spark, sf), KEY, TS, "Load", (24, 168)))


def win_rolling_std(spark, sf):
    return C.rounded(ordered.rolling_std(_h(spark, sf), KEY, TS, "Load", 24))


def sort_series(spark, sf):
    return C.rounded(_h(spark, sf, reused=False).orderBy(KEY, TS))


def topk_first_n(spark, sf):
    return C.rounded(_h(spark, sf, reused=False).orderBy(KEY, TS).limit(10))


# --------------------------------------------------------------------------- samples, metrics, models

def smp_hash_fraction(spark, sf):
    return C.rounded(sampling.hash_sample(C.table(spark, sf, "events"), ["event_id"], 0.05, 42))


def smp_random_split(spark, sf):
    e = C.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.hash_split(e, ["event_id"], 0.2, 42, "is_test")


def ml_seasonal_naive(spark, sf):
    return C.rounded(metrics.seasonal_naive(_h(spark, sf), KEY, TS, "Load", 24))


def ml_error_metrics(spark, sf):
    f = metrics.seasonal_naive(_h(spark, sf), KEY, TS, "Load", 24)
    return C.rounded(metrics.error_metrics(f, "Load", "forecast", [KEY]), 4)


def ml_walk_forward(spark, sf):
    f = metrics.seasonal_naive(_h(spark, sf), KEY, TS, "Load", 24)
    return C.rounded(metrics.walk_forward_folds(f, KEY, TS, "Load", "forecast", "day", 1), 4)


def ml_walk_forward_refit(spark, sf):
    """X9 with a refit before every fold: the profile model (mean by weekday and hour) of all earlier days."""
    return C.rounded(metrics.walk_forward_refit(_h(spark, sf), KEY, TS, "Load", horizon_days=1), 4)


def ml_walk_forward_regression(spark, sf):
    """A regression on the values one and one and a week of horizons old, refitted before every fold of a day
    and of a week, beside the seasonal naive forecast; metrics per (series, horizon, fold, model)."""
    f = regression.walk_forward_regression(_h(spark, sf), KEY, TS, "Load", horizons={"day": 1, "week": 7})
    return C.rounded(regression.compare_models(f, [KEY, "horizon", "fold"]), 4)


def ml_walk_forward_horizons(spark, sf):
    """X9, M7 for the next day, week and month: daily order value (thousands) per priority over all years."""
    daily = C.calendar_orders(spark, sf).groupBy(F.col("o_orderpriority").alias(KEY), "Date").agg(
        (F.sum("o_totalprice") / 1000).alias("Load"))
    f = regression.walk_forward_regression(daily, KEY, "Date", "Load")
    return C.rounded(regression.compare_models(f, [KEY, "horizon"]), 4)


def smp_split_null_ids(spark, sf):
    """M2 with missing ids (every 10th event's): every row is kept and ranked."""
    e = C.table(spark, sf, "events").select("event_id", "event_type", F.when(F.col("event_id") % 10 != 0, F.col("event_id")).alias("maybe_id"))
    return sampling.hash_split(e, ["maybe_id", "event_id"], 0.2, 42, "is_test")


def dq_missing_hours_null_key(spark, sf):
    """J5 on a table in which one series has no key: it is a series like the others."""
    h = _h(spark, sf).withColumn(KEY, F.when(F.col(KEY) != "view", F.col(KEY)))
    return joins.missing_hours(h, [KEY], TS)


def ml_seasonal_naive_null_key(spark, sf):
    h = _h(spark, sf).withColumn(KEY, F.when(F.col(KEY) != "view", F.col(KEY)))
    return C.rounded(metrics.seasonal_naive(h, KEY, TS, "Load", 24))


def fcst_split_report(spark, sf):
    """M7's data path: rows and date spans of the as-of split, and its number of features."""
    return forecast.split_report(_features(spark, sf), "2024-01-25")


def rel_category_average(spark, sf):
    """the report by name, one key per kind."""
    o = timefeatures.add_time_features(C.calendar_orders(spark, sf).select("Date", F.col("o_totalprice").alias("Load")))
    return C.rounded(profile.check_relevance(o, "Day", "Load", "categoryAverage"), 4)


def rel_one_hot(spark, sf):
    return profile.check_relevance(C.table(spark, sf, "labels"), "quality", None, "oneHot")


def rel_one_hot_avg(spark, sf):
    docs = C.table(spark, sf, "documents").select("doc_id", "n_chars")
    both = docs.join(C.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return C.rounded(profile.check_relevance(both, "quality", "n_chars", "oneHotAvg"))


def rel_scatter(spark, sf):
    return C.rounded(profile.check_relevance(C.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "scatterPlot"))


def pipe_features_raw(spark, sf):
    """E1 from landed rows: labelled local wall time, zone name, missing loads -> UTC -> features."""
    h = _h(spark, sf)
    est = F.col(TS) - F.make_interval(hours=F.lit(5))  # January to March: Eastern standard time
    raw = h.select(F.date_format(est, "MM/dd/yyyy HH:mm:ss").alias("Time Stamp"), F.lit("EST").alias("Time Zone"), F.col(KEY).alias("Name"),
                   F.lit("61757").alias("PTID"), F.when(F.hour(TS) != 3, F.col("Load")).alias("Integrated Load"))
    return C.rounded(features.build_features_from_raw(raw, C.weather(spark, sf, h)).withColumnRenamed("Name", KEY))


def _features(spark, sf):
    h = _h(spark, sf)
    return features.build_features(h, C.weather(spark, sf, h))


def ml_gbt_random_split(spark, sf):
    res = forecast.forecast_random_split(_features(spark, sf))
    return res.predictions.select(KEY, TS, "Load", "prediction")


def ml_gbt_early_stop(spark, sf):
    res = forecast.forecast_as_of(_features(spark, sf), None, max_iter=200, max_depth=6)
    return res.predictions.select(KEY, TS, "Load_target", "prediction")


def topk_importance(spark, sf):
    res = forecast.forecast_random_split(_features(spark, sf))
    from ..operators import model
    return model.top_importances(res.fitted, spark, 10)


def pipe_forecast_asof(spark, sf):
    res = forecast.forecast_as_of(_features(spark, sf), "2024-01-25", max_iter=200, max_depth=6)
    return res.metrics


def fcst_rows(spark, sf):
    """M7: what is forecast: every test row once, with its actual value and a prediction."""
    res = forecast.forecast_as_of(_features(spark, sf), "2024-01-25", max_iter=10, max_depth=4)
    p = res.predictions
    return C.rounded(p.select(KEY, TS, "Load_target", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("has_prediction")))


def fcst_metrics(spark, sf):
    """The job's metrics against the same figures from its stored predictions by plain sums."""
    res = forecast.forecast_as_of(_features(spark, sf), "2024-01-25", max_iter=10, max_depth=4)
    e, a = F.col("Load_target") - F.col("prediction"), F.col("Load_target")
    own = res.predictions.select(F.struct(
        F.sum(e * e).alias("se"), F.sum(F.abs(e)).alias("ae"), F.sum(F.when(a != 0, F.abs(e / a))).alias("pe"),
        F.sum((a != 0).cast("int")).alias("nz"), F.count(e).alias("k"), F.stddev_pop(a).alias("sd")).alias("own")).scalar()

    def near(x, y):
        return F.abs(F.col(x) - y) <= 1e-9 * F.abs(y)

    mse = F.col("own.se") / F.col("own.k")
    return res.metrics.withColumn("own", own).select(
        "n", "n_zero_actual", near("mse", mse).alias("mse_ok"), near("rmse", F.sqrt(mse)).alias("rmse_ok"), near("mae", F.col("own.ae") / F.col("own.k")).alias("mae_ok"),
        near("mape", 100 * F.col("own.pe") / F.col("own.nz")).alias("mape_ok"), (F.col("rmse") < 2 * F.col("own.sd")).alias("rmse_bounded"))


def pipe_features(spark, sf):
    """The full feature table for every hourly series."""
    h = _h(spark, sf)
    return C.rounded(features.build_features(h, C.weather(spark, sf, h)))


# --------------------------------------------------------------------------- gap filling, exploration, monitoring

def fill_linear_single(spark, sf):
    return C.rounded(fill.fill_linear_single(_h(spark, sf), KEY, TS, "Load"))


def fill_pattern(spark, sf):
    return C.rounded(fill.fill_pattern(_h(spark, sf), KEY, TS, "Load"))


def dq_outliers_iqr(spark, sf):
    return C.rounded(eda.iqr_outliers(_h(spark, sf), KEY, "Load"))


def eda_seasonality(spark, sf):
    return C.rounded(eda.seasonality(_h(spark, sf, reused=False), KEY, TS, "Load"))


def eda_trend(spark, sf):
    return C.rounded(eda.trend(_h(spark, sf, reused=False), KEY, TS, "Load"), 4)


def eda_autocorr(spark, sf):
    return C.rounded(eda.autocorrelation(_h(spark, sf), KEY, TS, "Load"))


def mon_drift(spark, sf):
    return C.rounded(monitor.drift(_h(spark, sf), KEY, TS, "Load"), 4)


def ml_threshold_search(spark, sf):
    h = _h(spark, sf)
    both = joins.add_temperature(h, C.weather(spark, sf, h), TS, TS, "temp")
    return C.rounded(thresholds.threshold_search(both, "Temperature", "Load", 1.0, keys=[KEY]), 3)


QUERIES: dict[str, Query] = {name: fn for name, fn in list(globals().items())
                             if callable(fn) and not name.startswith("_") and fn.__module__ == __name__
                             and name not in ("Query",)}
