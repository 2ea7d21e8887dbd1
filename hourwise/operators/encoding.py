"""Target encoding of a series key (M3): one numeric column, whatever the number of series, made of past rows only.

A training row gets the smoothed mean label of its series over the days up to ``gap_days`` + 1 before its own, from
prefix sums over one row a series and day; a row to be scored gets the mean over the whole training part.  Means are
drawn towards the mean over all series of the same days by ``strength`` rows, so a series without a past has that mean.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .ordered import _norm_keys, null_safe_join


def _smoothed(total: Column, n: Column, prior: Column, strength: float) -> Column:
    return F.try_divide(F.coalesce(total, F.lit(0.0)) + strength * prior, F.coalesce(n, F.lit(0)) + strength)


def past_key_means(df: DataFrame, keys: Sequence[str], ts: str, label: str, out: str, *, gap_days: int = 1,
                   strength: float = 10.0) -> DataFrame:
    """``df`` with ``out``: the smoothed mean of ``label`` over the rows of the same series that are at least
    ``gap_days`` + 1 days older; NULL where no row of any series is."""
    day = F.unix_date(F.to_date(F.col(ts))).alias("_day")
    daily = materialized(df.groupBy(*keys, day).agg(F.sum(label).alias("_s"), F.count(label).alias("_n")), "daily-labels")
    every = daily.groupBy("_day").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    reach = (Window.unboundedPreceding, -gap_days - 1)
    w = Window.orderBy("_day").rangeBetween(*reach)  # one row a day
    prior = every.select("_day", F.try_divide(F.sum("_s").over(w), F.sum("_n").over(w)).alias("_prior"))
    normed, own = _norm_keys(daily, keys)
    w = Window.partitionBy(*own).orderBy("_day").rangeBetween(*reach)  # one row a series and day
    past = normed.select(*keys, "_day", F.sum("_s").over(w).alias("_s"), F.sum("_n").over(w).alias("_n"))
    past = past.join(prior, "_day").select(*keys, "_day", _smoothed(F.col("_s"), F.col("_n"), F.col("_prior"), strength).alias(out))
    return null_safe_join(df.withColumn("_day", day), past, list(keys), plain=["_day"], how="left").drop("_day")


@dataclass
class KeyMeans:
    """What a training part says about its series."""

    table: DataFrame  # keys, _s, _n
    keys: list[str]
    prior: float | None
    out: str
    strength: float = 10.0

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` with the smoothed mean of each row's series; a series not trained on has the mean of all."""
        joined = null_safe_join(df, self.table, self.keys, how="left")
        return joined.withColumn(self.out, _smoothed(F.col("_s"), F.col("_n"), F.lit(self.prior), self.strength)).drop("_s", "_n")


def key_means(df: DataFrame, keys: Sequence[str], label: str, out: str, *, strength: float = 10.0) -> KeyMeans:
    table = materialized(df.groupBy(*keys).agg(F.sum(label).alias("_s"), F.count(label).alias("_n")), "key-means")
    total = table.agg(F.sum("_s"), F.sum("_n")).first()
    return KeyMeans(table, list(keys), total[0] / total[1] if total[1] else None, out, strength)
