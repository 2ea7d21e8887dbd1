"""Exact quantiles with linear interpolation (pandas ``quantile`` / SQL ``percentile_cont``).

Spark's exact ``percentile`` keeps every value of a group in one aggregation
buffer; at scale that is one task holding a whole column.  Two exact methods
are offered instead:

* ``histogram`` (default): count / min / max per group; an equal-width
  histogram per group (at most ``bins`` rows per group, partial-aggregated);
  a prefix sum over that small table locates the bucket holding each target
  rank.  A bucket that still holds many different values is cut again, so a
  heavy tail or an outlier never leaves most rows in one bucket; only small
  buckets are ranked.  No full sort of the column; usually three reads.
* ``sort``: one range-partitioned sort of all values (a hot group spreads over
  many partitions) and a dense rank from per-partition counts.

Both keep only the <= 2 values per probability that bracket each position.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialized
from .ordered import _null_safe_join, sorted_index

RANKED_ROWS = 100_000  # rows of one bucket that a single task may rank
MAX_ROUNDS = 64  # each round divides a range of values by the number of bins


def _pname(p: float) -> str:
    return f"q{round(p * 100, 6):g}".replace(".", "_")


def grouped_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
                      names: Sequence[str] | None = None, *, approx: bool = False, accuracy: int = 10_000,
                      method: str = "histogram", bins: int = 1 << 14, extra=None,
                      groups_bound: int | None = None) -> DataFrame:
    """One row per group with one column per probability; NULL and NaN values are ignored.

    ``approx=True`` uses ``percentile_approx`` (one pass, bounded memory) for
    when an approximate answer is acceptable.  ``extra`` maps output names to
    functions of the value column (e.g. ``F.avg``) computed in the same pass
    as the group sizes, so a summary needs no separate scan.  ``groups_bound``
    is a proven upper bound on the number of groups (e.g. the number of
    profiled columns); when it is small, the per-group tables are broadcast so
    the values are never shuffled for those joins.
    """
    extra = dict(extra or {})
    names = list(names or [_pname(p) for p in probs])
    g = list(group)
    v = df.select(*g, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if approx:
        qs = F.percentile_approx("_v", list(probs), accuracy)
        more = [fn(F.col("_v")).alias(k) for k, fn in extra.items()]
        return v.groupBy(*g).agg(qs.alias("_qs"), *more).select(
            *g, *extra, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])
    whole = not g
    if whole:  # one global group: a constant key whose one-row size table is broadcast (bound: 1 row)
        v, g = v.withColumn("__all", F.lit(0)), ["__all"]
    sizes = v.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                              *[fn(F.col("_v")).alias(k) for k, fn in extra.items()])
    sizes = materialized(sizes, "quantile-sizes")
    small = whole or (groups_bound is not None and groups_bound <= 100_000)
    if method == "sort":
        picked = _ranked_by_sort(v, g, probs)
    elif method == "histogram":
        picked = _ranked_by_histogram(v, g, probs, bins, sizes, small)
    else:
        raise ValueError("method must be 'histogram' or 'sort'")
    # picked: (group..., _p, _k, _val, _pos) for the two ranks around each position
    aggs = []
    for i, n in enumerate(names):
        pos = F.col("_pos")
        mine = F.col("_p") == i
        lo = F.max(F.when(mine & (F.col("_k") == F.floor(pos)), F.col("_val")))
        hi = F.max(F.when(mine & (F.col("_k") == F.ceil(pos)), F.col("_val")))
        frac = F.max(F.when(mine, pos - F.floor(pos)))
        aggs.append((lo + (hi - lo) * frac).alias(n))
    out = picked.groupBy(*g).agg(*aggs)
    if extra:
        out = _null_safe_join(out, sizes.select(*g, *extra), g, broadcast_right=small)
    return out.drop("__all") if whole else out


def _targets(sizes: DataFrame, g: list[str], probs: Sequence[float], *more: str) -> DataFrame:
    """(group..., _n, _p, _pos, _k) for k in {floor(pos), ceil(pos)}, pos = p * (n - 1)."""
    recs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        for k in (F.floor(pos), F.ceil(pos)):
            recs.append(F.struct(F.lit(i).alias("_p"), pos.alias("_pos"), k.cast("long").alias("_k")))
    t = sizes.select(*g, "_n", *more, F.explode(F.array_distinct(F.array(*recs))).alias("_t"))
    return t.select(*g, "_n", "_t._p", "_t._pos", "_t._k", *more)


def _ranked_by_sort(v: DataFrame, g: list[str], probs: Sequence[float]) -> DataFrame:
    idx = sorted_index(v, ["_v"], group=g, index_col="_k", count_col="_n")
    sizes = idx.select(*g, "_n").distinct()
    tg = _targets(sizes, g, probs).drop("_n")
    return _null_safe_join(idx.select(*g, "_k", F.col("_v").alias("_val")), tg, [*g, "_k"])


def _ranked_by_histogram(v: DataFrame, g: list[str], probs: Sequence[float], bins: int, sizes: DataFrame,
                         small: bool = False, most: int = RANKED_ROWS) -> DataFrame:
    """The rows at the target ranks.  Ranges of values that hold a target are cut into ``bins`` equal parts again and
    again until the part that holds it has one value only or at most ``most`` rows; those are ranked by a window.  A
    heavy tail only costs another round.  Each round is one read of the values; its small tables are materialised, so
    no round repeats an earlier one."""
    ranges = _targets(sizes, g, probs, "_lo", "_hi").withColumn("_before", F.lit(0).cast("long"))
    found, rounds = [], 0
    while True:
        # one value: the target is known; few rows: to be ranked; else the range is cut
        ranges = materialized(ranges, "quantile-ranges")
        flat = ranges.filter(F.col("_lo") == F.col("_hi")).select(*g, "_p", "_k", "_pos", F.col("_lo").alias("_val"))
        found.append(flat)
        wide = ranges.filter((F.col("_lo") < F.col("_hi")) & (F.col("_n") > most))
        if rounds >= MAX_ROUNDS or wide.isEmpty():
            break
        rounds += 1
        spans = wide.select(*g, F.col("_lo").alias("_l"), F.col("_hi").alias("_h")).distinct()
        inside = _null_safe_join(v, spans, g, broadcast_right=small).filter(F.col("_v").between(F.col("_l"), F.col("_h")))
        width = (F.col("_h") / bins - F.col("_l") / bins)  # the difference itself may overflow
        bucket = F.when(width > 0, F.least(F.floor(F.col("_v") / width - F.col("_l") / width), F.lit(bins - 1).cast("double"))).otherwise(F.lit(0.0))
        hist = inside.groupBy(*g, "_l", "_h", bucket.cast("long").alias("_b")).agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"), F.max("_v").alias("_bmax"))
        w = Window.partitionBy(*g, "_l", "_h").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        narrowed = _null_safe_join(wide.withColumns({"_l": F.col("_lo"), "_h": F.col("_hi")}), hist, g, plain=["_l", "_h"]).filter(
            (F.col("_k") - F.col("_before") >= F.col("_off")) & (F.col("_k") - F.col("_before") < F.col("_off") + F.col("_c")))
        narrowed = narrowed.select(*g, F.col("_c").alias("_n"), "_p", "_pos", "_k", F.col("_bmin").alias("_lo"), F.col("_bmax").alias("_hi"),
                                   (F.col("_before") + F.col("_off")).alias("_before"))
        ranges = ranges.filter((F.col("_lo") < F.col("_hi")) & (F.col("_n") <= most)).select(narrowed.columns).unionByName(narrowed)
    need = ranges.filter(F.col("_lo") < F.col("_hi"))
    spans = need.select(*g, F.col("_lo").alias("_l"), F.col("_hi").alias("_h")).distinct()
    band = _null_safe_join(v, spans, g, broadcast_right=small).filter(F.col("_v").between(F.col("_l"), F.col("_h")))
    wr = Window.partitionBy(*g, "_l", "_h").orderBy("_v")
    ranked = band.withColumn("_r", F.row_number().over(wr) - 1)
    wanted = need.select(*g, F.col("_lo").alias("_l"), F.col("_hi").alias("_h"), "_p", "_k", "_pos", (F.col("_k") - F.col("_before")).alias("_r"))
    exact = _null_safe_join(ranked.select(*g, "_l", "_h", "_r", F.col("_v").alias("_val")), wanted, g, plain=["_l", "_h", "_r"])
    found.append(exact.select(*g, "_p", "_k", "_pos", "_val"))
    return reduce(DataFrame.unionByName, found)


def unpivot_numeric(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """Long format ``(column, value double)`` of the given numeric columns."""
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), name, value
    )


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str] | None = None,
                     *, approx: bool = False, extra=None) -> DataFrame:
    """Quantiles of several columns at once: ``(column, [extra...], q...)``."""
    return grouped_quantiles(unpivot_numeric(df, columns), ["column"], "value", probs, names, approx=approx, extra=extra,
                             groups_bound=len(columns))
