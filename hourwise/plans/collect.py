"""Collect landed monthly archives into a month-partitioned table and report months that are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..sources import files, zips

LOAD_RAW_SCHEMA = StructType([
    StructField("Time Stamp", StringType()),
    StructField("Time Zone", StringType()),
    StructField("Name", StringType()),
    StructField("PTID", StringType()),
    StructField("Integrated Load", DoubleType()),
])


def collect_archives(spark: SparkSession, landing_glob: str, target: str, *, zone: str | None = None,
                     start: str = "20010601", end: str | None = None) -> DataFrame:
    """Read every archive (optionally one zone), merge its rows into ``month=yyyyMM`` partitions (by zone, time and
    label: other zones of a month stay, a repeated delivery changes nothing), and return the expected months
    (``partition``, ``month_start``) that have no rows, up to ``end`` (none: the current month)."""
    raw = zips.read_zip_csv(spark, landing_glob, LOAD_RAW_SCHEMA, zone_col="Name" if zone else None, zone=zone)
    with_ts = raw.withColumn("_local", F.to_timestamp_ntz(F.col("Time Stamp"), F.lit("MM/dd/yyyy HH:mm:ss")))
    files.write_month_partitions(with_ts.drop("source_member"), target, "_local", keys=["Name", "PTID", "Time Stamp", "Time Zone"])
    expected = files.month_partitions(
        spark.range(1).select(F.to_date(F.lit(start), "yyyyMMdd").alias("start"), (F.to_date(F.lit(end), "yyyyMMdd") if end else F.current_date()).alias("end")))
    landed = files.read_month_partitions(spark, target).select(F.col("month")).distinct()
    return expected.join(landed, F.date_format("month_start", "yyyyMM") == F.col("month"), "left_anti")
