"""File sources and sinks: CSV (S1, S5), month partitions (S3, S4), time-range scans (S6), unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.nulls import normalise_nan
from . import months


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, *, header: bool = True,
             multi_line: bool = False) -> DataFrame:
    """Headered CSV with an explicit schema (no inference pass); NaN and empty cells -> NULL.

    Quotes inside a quoted cell are doubled, as the CSV standard has it.  ``multi_line`` allows line breaks inside
    quoted cells (a file is then read by one task)."""
    rd = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").option("quote", '"').option("escape", '"')
    rd = rd.option("multiLine", multi_line)
    return normalise_nan(rd.csv(path if isinstance(path, str) else list(path)))


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Headered CSV, no index column, quotes doubled; replaces the target."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table (Parquet by default)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def month_partitions(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """S3: one row per month from ``start``'s month to ``end``'s month, both included:
    ``(partition 'yyyyMM01', month_start date)``.  ``bounds`` holds one row per range."""
    lo = F.trunc(F.col(start).cast("date"), "month")
    hi = F.trunc(F.col(end).cast("date"), "month")
    m = bounds.select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return m.select(F.date_format("month_start", "yyyyMM01").alias("partition"), "month_start")


def write_month_partitions(df: DataFrame, path: str, ts: str, month_col: str = "month", keys: Sequence[str] | None = None,
                           order: Sequence[str] = ()) -> None:
    """Write rows under ``month=yyyyMM`` partitions.

    With ``keys`` the rows are merged with the stored ones of the same months (``months.upsert_months``): a second
    delivery of a month adds to the first, and a repeated one changes nothing.  Without ``keys`` a delivery is the
    whole month and replaces it.  Other months are untouched, and with keys unread, either way (dynamic partition
    overwrite).  The ``rebalance`` hint lets AQE group rows by month into right-sized tasks: few files per month, and a
    hot month is split rather than written by one task.
    """
    if keys:
        months.upsert_months(df, path, ts, keys, order=order, month=month_col)
    else:
        months._write(months.with_month(df, ts, month_col), path, month_col, "overwrite")


def read_month_partitions(spark: SparkSession, path: str, only: Sequence[str] | None = None,
                          month_col: str = "month") -> DataFrame:
    """One scan over the chosen month partitions (all when ``only`` is None), month kept as text."""
    if only is None:
        df = spark.read.parquet(path)
    else:
        df = spark.read.option("basePath", path).parquet(*[f"{path}/{month_col}={m}" for m in only])
    return normalise_nan(df.withColumn(month_col, F.col(month_col).cast("string")))


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name (missing columns become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def time_range_scan(spark: SparkSession, path: str, ts: str, start, end) -> DataFrame:
    """Rows of a landed observation table with ``start <= ts <= end``; the bounds reach the Parquet scan."""
    df = normalise_nan(spark.read.parquet(path))
    return df.filter(F.col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
