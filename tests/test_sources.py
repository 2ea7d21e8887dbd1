import datetime as dt
import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from hourwise.plans import collect
from hourwise.sources import files, zips


def _fresh(prefix):
    return tempfile.mkdtemp(prefix=f"hw-{prefix}-", dir="/tmp")


def _member_csv(day: dt.date, hours=24):
    lines = ["Time Stamp,Time Zone,Name,PTID,Integrated Load"]
    for zone, ptid in (("N.Y.C.", "61761"), ("CAPITL", "61757")):
        for h in range(hours):
            load = "" if h == 5 else f"{1000 + h}.5"
            lines.append(f"{day:%m/%d/%Y} {h:02d}:00:00,EST,{zone},{ptid},{load}")
    return "\n".join(lines) + "\n"


def _write_zip_month(folder, month: dt.date):
    """zip_month: one archive per month, two daily CSV members, 24 hours x 2 zones, one empty load per zone and member."""
    path = os.path.join(folder, f"{month:%Y%m}01palIntegrated_csv.zip")
    with zipfile.ZipFile(path, "w") as zf:
        for d in (1, 2):
            day = month.replace(day=d)
            zf.writestr(f"{day:%Y%m%d}pal.csv", _member_csv(day))
    return path


def test_zip_ingest_reads_every_member(spark):
    land = _fresh("zip")
    _write_zip_month(land, dt.date(2024, 1, 1))
    _write_zip_month(land, dt.date(2024, 2, 1))
    df = zips.read_zip_csv(spark, os.path.join(land, "*.zip"), collect.LOAD_RAW_SCHEMA)
    assert df.count() == 192
    assert df.filter(F.col("Integrated Load").isNull()).count() == 8
    assert df.filter(F.isnan("Integrated Load")).count() == 0
    nyc = zips.read_zip_csv(spark, os.path.join(land, "*.zip"), collect.LOAD_RAW_SCHEMA, zone_col="Name", zone="N.Y.C.")
    assert nyc.count() == 96


def test_collect_archives_reports_missing_months(spark):
    land, target = _fresh("land"), _fresh("target")
    _write_zip_month(land, dt.date(2024, 1, 1))
    _write_zip_month(land, dt.date(2024, 3, 1))
    missing = collect.collect_archives(spark, os.path.join(land, "*.zip"), target, zone="N.Y.C.",
                                       start="20240101", end="20240301")
    assert [r["partition"] for r in missing.collect()] == ["20240201"]
    assert files.read_month_partitions(spark, target).count() == 96


def test_month_partition_rewrite_is_idempotent(spark):
    """month_twice: the same month written twice keeps its row count; other months stay."""
    target = _fresh("months")
    rows = [(dt.datetime(2024, m, d), float(m * 100 + d)) for m in (1, 2) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    files.write_month_partitions(df, target, "ts")
    files.write_month_partitions(df.filter(F.month("ts") == 1), target, "ts")
    back = files.read_month_partitions(spark, target)
    assert back.count() == 20
    assert sorted(r["month"] for r in back.select("month").distinct().collect()) == ["202401", "202402"]
    jan = files.read_month_partitions(spark, target, ["202401"])
    assert jan.count() == 10


def test_month_list_both_ends(spark):
    b = spark.createDataFrame([(dt.date(2001, 6, 1), dt.date(2025, 4, 1))], "start date, end date")
    m = files.month_partitions(b)
    parts = [r["partition"] for r in m.orderBy("month_start").collect()]
    assert len(parts) == 287 and parts[0] == "20010601" and parts[-1] == "20250401"


def test_csv_roundtrip_nan_and_empty(spark):
    """nan_in: NaN text and an empty cell both read back as NULL."""
    folder = _fresh("csv")
    with open(os.path.join(folder, "a.csv"), "w") as fh:
        fh.write("k,v\na,1.5\nb,NaN\nc,\n")
    schema = StructType([StructField("k", StringType()), StructField("v", DoubleType())])
    df = files.read_csv(spark, os.path.join(folder, "a.csv"), schema)
    assert [(r["k"], r["v"]) for r in df.orderBy("k").collect()] == [("a", 1.5), ("b", None), ("c", None)]
    out = os.path.join(folder, "out")
    files.write_csv(df, out)
    files.write_csv(df, out)
    assert files.read_csv(spark, out, schema).count() == 3


def test_time_range_scan_pushes_filter(spark):
    df = files.time_range_scan(spark, "/root/testdata/sf0.001/events.parquet", "ts", "2024-01-02", "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert df.agg(F.min("ts"), F.max("ts")).first()[0] >= dt.datetime(2024, 1, 2)


def test_union_frames_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2, 3.0)], "s string, id int, extra double")
    out = files.union_frames([a, b]).orderBy("id").collect()
    assert [(r["id"], r["s"], r["extra"]) for r in out] == [(1, "x", None), (2, "y", 3.0)]


def test_one_task_for_each_member(spark):
    land = _fresh("members")
    _write_zip_month(land, dt.date(2024, 1, 1))
    df = zips.read_zip_csv(spark, land, collect.LOAD_RAW_SCHEMA)
    per_task = df.groupBy(F.spark_partition_id().alias("p"), "source_member").count().collect()
    assert len(per_task) == 2 and len({r.p for r in per_task}) == 2 and {r["count"] for r in per_task} == {48}


def test_members_of_other_shapes(spark):
    land, conf = _fresh("shapes"), spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with zipfile.ZipFile(os.path.join(land, "x.zip"), "w") as zf:
        zf.writestr("empty.csv", "")
        zf.writestr("header.csv", "a,b\n")
        zf.writestr("quoted.csv", 'more,b,a\n1,"x, ""y""\nz",NaN\n2,,5\n')
        zf.writestr("lacks.csv", "a\n7\n")
        zf.writestr("notes.txt", "a\n9\n")
        zf.writestr("large.csv", "a,b\n" + "".join(f"{i},{'w' * 50}\n" for i in range(60000)))
    schema = StructType([StructField("a", DoubleType()), StructField("b", StringType())])
    df = zips.read_zip_csv(spark, f"file:{land}/*.zip", schema)
    small = df.filter("source_member NOT LIKE '%large%'")
    assert sorted(((r.a, r.b) for r in small.collect()), key=str) == sorted([(None, 'x, "y"\nz'), (5.0, None), (7.0, None)], key=str)
    big = df.filter("source_member LIKE '%large%'").agg(F.count("b"), F.sum("a")).first()
    assert tuple(big) == (60000, 60000 * 59999 / 2)
    assert zips.read_zip_csv(spark, f"{land}/none*.zip", schema).count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == conf  # no setting is left behind


def test_zip_sink_round_trip(spark):
    land = _fresh("sink")
    rows = [(f"2024{m:02d}", f"d{d}", m * d, None if d == 2 else f'text "{d}", {m}') for m in (1, 2, 3) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows * 2, "a string, m string, n int, t string")
    assert zips.write_zip_csv(df, land, "a", "m") == 3 == zips.write_zip_csv(df, land, "a", "m")
    assert sorted(os.listdir(land)) == ["202401.zip", "202402.zip", "202403.zip"]
    back = zips.read_zip_csv(spark, land, df.select("n", "t").schema)
    assert sorted(((os.path.basename(r.source_member), r.n, r.t) for r in back.collect()), key=str) == sorted(
        [(f"{a}.zip!{m}.csv", n, t) for a, m, n, t in rows * 2], key=str)
