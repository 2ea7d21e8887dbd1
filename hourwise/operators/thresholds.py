"""Search for the hot / cold temperature thresholds.

Each candidate threshold splits the hours into flagged and not flagged; the
score is the reduction of squared error of the load when each side is
predicted by its own mean (a one-split regression stump).  Instead of
crossing candidates with rows, rows are aggregated per candidate bin
(count, sum, sum of squares) and running totals over the small bin table
score every candidate at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def threshold_search(df: DataFrame, temp: str = "Temperature", load: str = "Load", step: float = 1.0,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Best threshold per series and flag: ``(keys..., flag, threshold, gain, n_flagged)``; hot = temp > threshold,
    cold = temp < threshold, candidates are multiples of ``step``; ties -> lower threshold.

    One read: every row counts for two candidate bins (hot and cold); the totals and the running sums come from the
    per-bin aggregate.  Its windows run over one row per (series, flag, candidate), that is the temperature range
    divided by ``step``."""
    keys = list(keys)
    y, t = F.col(load), F.col(temp)
    d = df.filter(t.isNotNull() & y.isNotNull())
    # Candidate t (in steps): hot <=> temp > t*step <=> ceil(temp/step) - 1 >= t;
    #                         cold <=> temp < t*step <=> floor(temp/step) + 1 <= t.
    sides = F.array(F.struct(F.lit("hot").alias("flag"), (F.ceil(t / step) - 1).cast("long").alias("b")),
                    F.struct(F.lit("cold").alias("flag"), (F.floor(t / step) + 1).cast("long").alias("b")))
    g = (d.select(*keys, y.alias("_y"), F.explode(sides).alias("_f")).groupBy(*keys, "_f.flag", "_f.b")
         .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("q")))
    # flagged for candidate t: bins >= t (hot) or bins <= t (cold)
    part = Window.partitionBy(*keys, "flag")
    run = part.orderBy(F.when(F.col("flag") == "hot", -F.col("b")).otherwise(F.col("b"))).rowsBetween(Window.unboundedPreceding, 0)
    c = g.select(*keys, "flag", "b", *[F.sum(x).over(run).alias(f"{x}1") for x in "nsq"], *[F.sum(x).over(part).alias(x) for x in "nsq"])
    n0, s0, q0 = (F.col(x) - F.col(f"{x}1") for x in "nsq")
    sse_total = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    sse1 = F.col("q1") - F.col("s1") * F.col("s1") / F.col("n1")
    sse0 = F.when(n0 > 0, q0 - s0 * s0 / n0).otherwise(F.lit(0.0))
    scored = c.select(*keys, "flag", (F.col("b") * F.lit(step)).alias("threshold"), (sse_total - sse1 - sse0).alias("gain"), F.col("n1").alias("n_flagged"))
    best = part.orderBy(F.desc("gain"), F.asc("threshold"))
    return scored.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")
