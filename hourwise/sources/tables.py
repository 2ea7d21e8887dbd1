"""Reading the landed tables and deriving the hourly demand series from them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import normalise_nan
from ..functions.timefns import hour_start


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet scan of ``{base}/{name}.parquet`` with NaN mapped to NULL.

    Columns are pruned as usual.  Filters on non-floating columns reach the scan; a filter on a floating column does
    not, since it stands above the NaN mapping."""
    return normalise_nan(spark.read.parquet(os.path.join(base, f"{name}.parquet")))


def hourly_demand(
    events: DataFrame,
    key: str = "event_type",
    ts: str = "ts",
    value: str = "value",
    *,
    key_out: str = "series",
    ts_out: str = "Timestamp",
    value_out: str = "Load",
) -> DataFrame:
    """Hourly mean of ``value`` per series: ``(series, Timestamp, Load)``.

    A partial (map-side) aggregate on ``(key, hour)``: a hot key is spread
    over its hours before the shuffle, and the result has at most one row per
    series and hour.
    """
    return events.groupBy(F.col(key).alias(key_out), hour_start(ts).alias(ts_out)).agg(
        F.avg(F.col(value)).alias(value_out)
    )
