import os
import tempfile

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from hourwise.streaming.ingest import run_once

SCHEMA = StructType([StructField("Name", StringType()), StructField("ts", TimestampNTZType()),
                     StructField("load", DoubleType())])


def test_incremental_ingest_totals(spark):
    """stream_batches: file a: 2 rows; file b: 1 repeat + 1 new; third run without files -> totals 2, 3, 3."""
    base = tempfile.mkdtemp(prefix="hw-stream-", dir="/tmp")
    src, tgt, ck = (os.path.join(base, x) for x in ("src", "tgt", "ck"))
    os.makedirs(src)
    kw = dict(keys=["Name", "ts"], ts="ts")

    def write(name, lines):
        with open(os.path.join(src, name), "w") as fh:
            fh.write("Name,ts,load\n" + "\n".join(lines) + "\n")

    totals = []
    write("a.csv", ["N.Y.C.,2024-01-01 00:00:00,1.0", "N.Y.C.,2024-01-01 01:00:00,2.0"])
    run_once(spark, src, SCHEMA, tgt, ck, **kw)
    totals.append(spark.read.parquet(tgt).count())
    write("b.csv", ["N.Y.C.,2024-01-01 01:00:00,2.0", "N.Y.C.,2024-01-01 02:00:00,3.0"])
    run_once(spark, src, SCHEMA, tgt, ck, **kw)
    totals.append(spark.read.parquet(tgt).count())
    run_once(spark, src, SCHEMA, tgt, ck, **kw)
    totals.append(spark.read.parquet(tgt).count())
    assert totals == [2, 3, 3]
    # rows much older than all before them still land, once
    write("c.csv", ["N.Y.C.,2020-01-01 00:00:00,4.0", "N.Y.C.,2020-01-01 00:00:00,4.0", ",2020-01-01 00:00:00,5.0"])
    run_once(spark, src, SCHEMA, tgt, ck, **kw)
    assert spark.read.parquet(tgt).count() == 5
