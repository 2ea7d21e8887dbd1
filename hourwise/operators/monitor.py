"""Drift monitoring -- per-period level and distribution shift against a reference period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import null_safe_join


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def drift(df: DataFrame, key, ts: str = "Timestamp", value: str = "Load", period: str = "week", bins: int = 10,
          eps: float = 1e-4) -> DataFrame:
    """Per (series, period): n, mean, std, mean shift vs. the series' first period, and the population
    stability index (PSI) over ``bins`` equal-width bins of the reference period's range (outer values
    clamped into the end bins; empty bins get share ``eps``).

    Two reads of the series: one for each period's count, least and largest value (from which the reference period
    and its range follow), one for n, sum and sum of squares by (series, period, bin).  Everything else is computed
    from that second, small table.  Squares are taken around the reference mean, so the standard deviation does not
    suffer from cancellation."""
    keys = _keys(key)
    p = F.date_trunc(period, F.col(ts)).cast("timestamp_ntz")
    d = df.select(*keys, p.alias("period"), F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    spans = d.groupBy(*keys, "period").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.avg("_v").alias("_m"))
    ref = spans.groupBy(*keys).agg(F.min_by(F.struct("period", "_lo", "_hi", "_m"), "period").alias("_r")).select(
        *keys, F.col("_r.period").alias("_ref"), "_r._lo", "_r._hi", F.col("_r._m").alias("_ref_mean"))
    width = F.col("_hi") - F.col("_lo")
    raw_bin = F.when(width > 0, F.floor((F.col("_v") - F.col("_lo")) / width * bins) + 1).otherwise(F.lit(1))
    x = F.col("_v") - F.col("_ref_mean")
    binned = null_safe_join(d, ref, keys).select(
        *keys, "period", "_ref", "_ref_mean", F.least(F.greatest(raw_bin, F.lit(1)), F.lit(bins)).cast("int").alias("_b"), x.alias("_x"))
    small = binned.groupBy(*keys, "period", "_ref", "_ref_mean", "_b").agg(
        F.count(F.lit(1)).alias("_c"), F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q"))
    counts = F.map_from_entries(F.collect_list(F.struct("_b", "_c")))  # at most ``bins`` entries
    per = small.groupBy(*keys, "period", "_ref", "_ref_mean").agg(
        F.sum("_c").alias("n"), F.sum("_s").alias("_s"), F.sum("_q").alias("_q"), counts.alias("_counts"))
    shares = F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda b: F.greatest(
        F.coalesce(F.try_element_at(F.col("_counts"), b), F.lit(0)) / F.col("n"), F.lit(eps)))
    per = per.withColumn("_shares", shares)
    first = per.filter(F.col("period") == F.col("_ref")).select(*keys, F.col("_shares").alias("_rshares"))
    both = null_safe_join(per, first, keys)
    terms = F.zip_with("_shares", "_rshares", lambda a, b: (a - b) * F.log(a / b))
    shift = F.col("_s") / F.col("n")
    var = (F.col("_q") - F.col("_s") * shift) / (F.col("n") - 1)
    return both.select(*keys, "period", "n", (F.col("_ref_mean") + shift).alias("mean"),
                       F.when(F.col("n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("std"), shift.alias("mean_shift"),
                       F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("psi"))
