"""X11: incremental ingest of newly landed files with Structured Streaming.

File source -> ``availableNow`` batches -> merge into month partitions.  Each run takes only files not seen before
(tracked in the checkpoint).  A batch is cut to one row a key and compared with the stored rows of the months it
touches, which are the only ones read; rows whose key is already there are repeats, all others are appended.  However
late a row arrives, it lands: there is no watermark to fall behind.

A journal beside the checkpoint holds the ids of the batches that were merged whole.  A batch that Spark hands over
again after a failure is known from it without a look at the target; one that failed between its last write and its
journal entry finds its own rows and adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.months import append_new

JOURNAL = "merged-batches"


def is_merged(spark: SparkSession, journal: str, batch_id: int) -> bool:
    """Whether the journal holds the batch."""
    try:
        spark.read.schema("id long").parquet(f"{journal}/batch={batch_id}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def note_merged(spark: SparkSession, journal: str, batch_id: int) -> None:
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{journal}/batch={batch_id}")


def merge_batch(batch: DataFrame, batch_id: int, target: str, journal: str, keys: Sequence[str], ts: str,
                order: Sequence[str] = ()) -> bool:
    """Merge a batch unless the journal holds it; whether it was merged now."""
    spark = batch.sparkSession
    if is_merged(spark, journal, batch_id):
        return False
    append_new(batch, target, ts, keys, order=order)
    note_merged(spark, journal, batch_id)
    return True


def incremental_ingest(spark: SparkSession, source_dir: str, schema: StructType, target: str, checkpoint: str, *,
                       keys: Sequence[str], ts: str, order: Sequence[str] = (), fmt: str = "csv", header: bool = True,
                       files_a_batch: int | None = None) -> StreamingQuery:
    """Start one availableNow run and return the (finishing) query; call ``awaitTermination()``.  ``keys`` name a row;
    a row's time ``ts`` never changes between deliveries.  Of the rows of one batch with equal keys the greatest by
    ``order`` (then by the other columns) lands.  The target has a partition column ``month``."""
    rd = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        rd = rd.option("header", header)
    if files_a_batch:
        rd = rd.option("maxFilesPerTrigger", files_a_batch)
    journal = f"{checkpoint}/{JOURNAL}"
    return (rd.load(source_dir).writeStream
            .foreachBatch(lambda batch, i: (merge_batch(batch, i, target, journal, keys, ts, order), None)[1])
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_once(spark: SparkSession, *args, **kw) -> None:
    q = incremental_ingest(spark, *args, **kw)
    q.awaitTermination()
