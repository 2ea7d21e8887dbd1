"""Joins: temperature onto load (J1), hourly grid gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import _norm_keys, null_safe_join, time_bucket


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (partial aggregate, no collect)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def add_temperature(load: DataFrame, weather: DataFrame, ts: str = "Timestamp", weather_ts: str = "Timestamp",
                    temp: str = "temp", out: str = "Temperature", *, check_unique: bool = True) -> DataFrame:
    """Left equi-join of one weather value per hour onto every load row.

    Only the temperature column crosses the join.  A weather hour listed twice
    would multiply load rows, so by default the weather side is aggregated to
    one row an hour inside the plan, and an hour with more than one row raises
    when the query runs (message ``weather has n rows for ...``); no job runs
    while the query is built.  Spark/AQE choose broadcast vs. sort-merge from
    the measured size of the weather side.
    """
    w = weather.select(F.col(weather_ts).alias(ts), F.col(temp).alias(out))
    if check_unique:
        n = F.count(F.lit(1))
        message = F.concat(F.lit("weather has "), n.cast("string"), F.lit(f" rows for {ts}="), F.coalesce(F.col(ts).cast("string"), F.lit("NULL")))
        w = w.filter(F.col(ts).isNotNull()).groupBy(ts).agg(F.when(n > 1, F.raise_error(message).cast("double")).otherwise(F.max(out)).alias(out))
    return load.join(w, ts, "left")


def _span_seconds():
    return F.timestamp_diff("SECOND", F.col("_lo"), F.col("_hi"))


def _bounds(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))


def hourly_grid(df: DataFrame, keys: Sequence[str], ts: str = "Timestamp", step_hours: int = 1) -> DataFrame:
    """Expected times per series: every ``step_hours`` from the series' first to last time, anchored at the first.

    Generated in two levels (days, then hours inside each day) with a
    repartition in between, so a long series is expanded by many tasks.
    """
    keys = list(keys)
    b = _bounds(df, keys, ts)
    step = step_hours * 3600
    n_steps = F.floor(_span_seconds() / F.lit(step))
    per_chunk = max(1, 24 // step_hours) * 7  # one chunk = a week of steps
    chunks = b.withColumn("_n", n_steps).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_n") / F.lit(per_chunk))))
    )
    chunks = chunks.repartition(*[F.col(k) for k in keys], "_chunk")
    first = F.col("_chunk") * F.lit(per_chunk)
    last = F.least(F.col("_n"), first + F.lit(per_chunk - 1))
    steps = chunks.withColumn("_s", F.explode(F.sequence(first, last)))
    t = F.col("_lo") + F.make_dt_interval(secs=F.col("_s") * F.lit(step))
    return steps.select(*keys, t.alias(ts))


def missing_hours(df: DataFrame, keys: Sequence[str], ts: str = "Timestamp", step_hours: int = 1) -> DataFrame:
    """Expected grid minus present times, per series (left anti join)."""
    keys = list(keys)
    present = df.select(*keys, ts)
    return null_safe_join(hourly_grid(df, keys, ts, step_hours), present, keys, plain=[ts], how="left_anti")


def except_hours(df: DataFrame, keys: Sequence[str], ts: str = "Timestamp", step_hours: int = 1) -> DataFrame:
    """Set difference (distinct) of the expected grid and the present times."""
    keys = list(keys)
    return hourly_grid(df, keys, ts, step_hours).subtract(df.select(*keys, ts))


def gap_report(df: DataFrame, keys: Sequence[str], ts: str = "Timestamp", first_n: int = 10, step_hours: int = 1) -> DataFrame:
    """Per series -- expected hours, available rows (duplicates counted), missing hours, first n missing.

    The expected times are every ``step_hours`` from the series' first time.  The present ones among them, in order,
    bound the gaps; only gaps are expanded, and no further than the first ``first_n`` missing times of a series
    (a gap's number of missing times is arithmetic).  Windows over a whole series see one row a week; times are put in
    order inside the weeks (at most ``first_n`` a series) that hold the first missing ones.
    """
    keys = list(keys)
    step = step_hours * 3600
    normed, names = _norm_keys(df.select(*keys, ts), keys)
    week = [*names, "_tb"]
    normed = normed.withColumn("_tb", F.coalesce(time_bucket(ts, 7), F.lit(-(2**62))))
    times = normed.groupBy(*keys, *week, ts).agg(F.count(F.lit(1)).alias("_rows"))
    series, before = Window.partitionBy(*names), Window.partitionBy(*names).orderBy("_tb")
    weeks = normed.groupBy(*week).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    weeks = weeks.select(*week, F.min("_lo").over(series).alias("_lo"), F.max("_hi").over(series).alias("_hi"))
    at = times.join(weeks, week).withColumn("_slot", F.floor(F.timestamp_diff("SECOND", F.col("_lo"), F.col(ts)) / F.lit(step)))
    on_grid = F.col("_lo") + F.make_dt_interval(secs=F.col("_slot") * F.lit(step)) == F.col(ts)
    at = at.withColumn("_end", F.floor(_span_seconds() / F.lit(step))).withColumn("_slot", F.when(on_grid, F.col("_slot")))

    by_week = at.groupBy(*keys, *week).agg(
        F.sum("_rows").alias("_rows"), F.max("_lo").alias("_lo"), F.max("_end").alias("_end"),
        F.min("_slot").alias("_first"), F.max("_slot").alias("_last"), F.count("_slot").alias("_n"))
    # the next present time after the week's last one; weeks without a present time have no gap of their own
    following = F.min("_first").over(before.rowsBetween(1, Window.unboundedFollowing))
    by_week = by_week.withColumn("_next", F.coalesce(following, F.col("_end") + 1))
    by_week = by_week.withColumn("_gap", F.col("_next") - F.col("_first") - F.col("_n"))
    by_week = by_week.withColumn("_before", F.coalesce(F.sum("_gap").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    wanted = by_week.where((F.col("_gap") > 0) & (F.col("_before") < first_n)).select(*week, "_next", F.col("_before").alias("_base"))
    order = Window.partitionBy(*week).orderBy("_slot")
    gaps = at.where(F.col("_slot").isNotNull()).select(*week, "_lo", "_slot").join(wanted, week)
    gaps = gaps.withColumn("_gap", F.coalesce(F.lead("_slot").over(order), F.col("_next")) - F.col("_slot") - 1)
    gaps = gaps.withColumn("_before", F.col("_base") + F.coalesce(F.sum("_gap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = F.least(F.col("_gap"), F.lit(first_n) - F.col("_before"))
    hours = F.transform(F.sequence(F.lit(1).cast("long"), n), lambda i: F.col("_lo") + F.make_dt_interval(secs=(F.col("_slot") + i) * F.lit(step)))
    firsts = gaps.where((F.col("_gap") > 0) & (F.col("_before") < first_n)).groupBy(*names).agg(
        F.sort_array(F.flatten(F.collect_list(hours))).alias("first_missing"))
    out = by_week.groupBy(*keys, *names).agg(
        F.sum("_rows").alias("available_rows"), (F.max("_end") + 1).alias("expected_hours"),
        F.coalesce(F.sum("_gap"), F.lit(0)).alias("missing_hours"))
    return out.join(firsts, names, "left").select(*keys, "available_rows", "expected_hours", "missing_hours", "first_missing")
