"""Seeded, exact-size samples and splits (M1, M2) that do not depend on partitioning.

Rows are ranked by ``md5(id || ':' || seed)`` (ties by id).  No row is shuffled to be ranked: the first five hex
digits of the hash give 2^20 ordered, uniformly filled buckets; counts per bucket (a partial aggregate, at most 2^20
rows) and their running sum give the one bucket in which the wanted rank falls.  Rows in lower buckets are taken by a
plain filter, and only the rows of the cut bucket are ordered.  Every step is a deterministic function of the row
values, so a recomputation yields the same rows, and any SQL engine with md5 computes the same order.

A NULL id is encoded like any other value, so every row has a rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BUCKET_DIGITS = 5  # 16^5 = 2^20 buckets


def hash_key(ids: Sequence[str], seed: int = 42) -> Column:
    """md5 of the ids and the seed, separated by ':' (escaped inside an id; NULL is ``\\N``, which no id can be)."""
    parts = [F.coalesce(F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")), F.lit("\\N"))
             for c in ids]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def _first_ranks(df: DataFrame, ids: Sequence[str], seed: int, wanted) -> tuple[DataFrame, DataFrame]:
    """(rows outside the cut bucket, rows of the cut bucket), each with ``_first``: among the first ``wanted(n)`` rows in hash order."""
    h = df.withColumn("_h", hash_key(ids, seed))
    h = h.withColumn("_hb", F.conv(F.substring("_h", 1, HASH_BUCKET_DIGITS), 16, 10).cast("long"))
    counts = h.groupBy("_hb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_hb")  # one partition, but at most 2^20 rows
    total = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    runs = counts.select("_hb", (after - F.col("_c")).alias("_before"), after.alias("_after"), wanted(total).alias("_k"))
    cut = runs.filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_after")))
    bucket = F.coalesce(cut.agg(F.max("_hb")).scalar(), F.lit(-1))  # nothing wanted: below every bucket
    left = F.coalesce(cut.agg(F.max(F.col("_k") - F.col("_before"))).scalar(), F.lit(0))
    rest = h.filter(F.col("_hb") != bucket).withColumn("_first", F.col("_hb") < bucket)
    inside = h.filter(F.col("_hb") == bucket)
    inside = inside.withColumn("_first", F.row_number().over(Window.partitionBy("_hb").orderBy("_h", *ids)) <= left)
    return rest.drop("_h", "_hb"), inside.drop("_h", "_hb")


def hash_sample(df: DataFrame, ids: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """``round(fraction * n)`` rows (half to even), the same rows for any partitioning."""
    rest, inside = _first_ranks(df, ids, seed, lambda n: F.bround(n * F.lit(fraction), 0))
    return rest.filter("_first").unionByName(inside.filter("_first")).drop("_first")


def hash_split(df: DataFrame, ids: Sequence[str], test_fraction: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Every row with ``out`` = true for the first ``ceil(test_fraction * n)`` rows in hash order."""
    rest, inside = _first_ranks(df, ids, seed, lambda n: F.ceil(n * F.lit(test_fraction)))
    return rest.unionByName(inside).withColumnRenamed("_first", out)
