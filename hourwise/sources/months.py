"""Merging deliveries into a month-partitioned table, reading only the months a delivery touches.

A delivery's months are few and known before the target is looked at: they are collected (at most ``MONTHS`` at a
time; a delivery of more is merged in several rounds) and pushed into the scan as literal partition filters, so months
that a delivery does not touch are neither listed as input nor read, whatever the target's size.

One row a key: where rows of one delivery share a key, the greatest one by ``order`` and then by all other columns
stays (NULL lowest), so that a replay in any order keeps the same row.  NULL keys equal each other, and rows without a
time form a month of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import null_safe_join
from ..session import materialized

MONTH = "month"
MONTHS = 1200  # months of one round: the bound of what is collected and of the pushed list


def with_month(df: DataFrame, ts: str, out: str = MONTH) -> DataFrame:
    return df.withColumn(out, F.date_format(F.col(ts), "yyyyMM"))


def one_row_a_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The greatest row of each key, by ``order`` and then by the other columns: one aggregate with partial maxima."""
    rest = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    if not rest:
        return df.dropDuplicates(list(keys))
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_best"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns])


def stored_table(spark: SparkSession, path: str, month: str = MONTH) -> DataFrame | None:
    """The table at ``path`` with its month as text, or None where nothing was written yet."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df.withColumn(month, F.col(month).cast("string"))


def month_filter(months: Sequence[str | None], month: str = MONTH) -> Column:
    """The partition filter of a short list of months."""
    own = [m for m in months if m is not None]
    named = F.col(month).isin(own) if own else F.lit(False)
    return named | F.col(month).isNull() if len(own) < len(months) else named


def month_lists(df: DataFrame, month: str = MONTH, most: int = MONTHS) -> Iterator[list[str | None]]:
    """The months of ``df`` in lists of at most ``most``, in order (a missing one first)."""
    after: Column = F.lit(True)
    while True:
        rows = df.where(after).select(month).distinct().orderBy(F.col(month).asc_nulls_first()).limit(most).collect()
        if rows:
            yield [r[0] for r in rows]
        if len(rows) < most:
            return
        after = F.col(month) > rows[-1][0] if rows[-1][0] is not None else F.col(month).isNotNull()


def _write(df: DataFrame, path: str, month: str, mode: str) -> None:
    (df.hint("rebalance", month).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path))


def upsert_months(df: DataFrame, path: str, ts: str, keys: Sequence[str], *, order: Sequence[str] = (), month: str = MONTH,
                  months_a_round: int = MONTHS) -> None:
    """Merge a delivery on ``keys``: a stored row stays unless a delivered row of its month has equal keys.  Only
    the delivery's months are read and rewritten; a repeated delivery changes nothing."""
    new = materialized(one_row_a_key(with_month(df, ts, month), [*keys, month], order), "delivery")
    for months in month_lists(new, month, months_a_round):
        own = new.where(month_filter(months, month))
        old = stored_table(new.sparkSession, path, month)
        if old is not None:
            kept = null_safe_join(old.where(month_filter(months, month)), own.select(*keys, month), [*keys, month], how="left_anti")
            # the months are rewritten from their own files, so the merged rows are written elsewhere first
            own = materialized(kept.unionByName(own, allowMissingColumns=True), "merged-months")
        _write(own, path, month, "overwrite")


def append_new(df: DataFrame, path: str, ts: str, keys: Sequence[str], *, order: Sequence[str] = (), month: str = MONTH,
               months_a_round: int = MONTHS) -> None:
    """X11: append the rows whose keys are not yet among the stored rows of their months; stored rows never change."""
    new = materialized(one_row_a_key(with_month(df, ts, month), [*keys, month], order), "delivery")
    for months in month_lists(new, month, months_a_round):
        own = new.where(month_filter(months, month))
        old = stored_table(new.sparkSession, path, month)
        if old is not None:
            # the months read are those written to: the new rows are written elsewhere before the append
            own = materialized(unseen(own, old, months, keys, month), "unseen")
        _write(own, path, month, "append")


def unseen(new: DataFrame, stored: DataFrame, months: Sequence[str | None], keys: Sequence[str], month: str = MONTH) -> DataFrame:
    """Rows of ``new`` without a stored row of equal keys; ``stored`` is read in ``months`` alone, its keys alone."""
    old = stored.where(month_filter(months, month)).select(*keys, month)
    return null_safe_join(new, old, [*keys, month], how="left_anti")
