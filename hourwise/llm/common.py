"""Shared helpers: bounded Arrow batches, scratch tables in the shared folder, byte and word arrays of many texts."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark alone (the path may be in a store that only Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches handed to Python tasks stay small whatever the texts' lengths: bounded by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # workers import this package from where the driver has it, whatever folder the job was started in
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


#: What glibc and Arrow are told in Python workers: freed arrays of 1 MB and more go back to the system at once.
LEAN = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(spark: SparkSession) -> None:
    """Python workers that wait between the stages of a long job hold little memory.  glibc raises its threshold with the
    largest array freed, so a worker keeps most of what it ever used; fixed thresholds end that.  To be called before
    a job's first Python function; settings of the cluster's own stay."""
    env = spark.sparkContext.environment
    for name, value in LEAN.items():
        env.setdefault(name, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: the lineage is cut, and a lost
    executor costs only the tasks that were running on it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Drop frames no longer referenced, so that Spark's cleaner removes the shuffle files of finished phases.  The
    cleaner works in the background on what the collector finds: the second round gets what the first one freed."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def row_and(src: DataFrame, ddl: str) -> StructType:
    """Schema of ``_row`` of ``src`` and the columns of ``ddl``."""
    return StructType([src.schema["_row"], *StructType.fromDDL(ddl).fields])


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items whose sizes add up to ``most`` at most; a larger item is alone in its slice."""
    start, total, n = 0, 0, 0
    for n, s in enumerate(sizes):
        if total and total + s > most:
            yield slice(start, n)
            start, total = n, 0
        total += s
        n += 1
    if n > start or total:
        yield slice(start, n)


#: Hash constants: an odd base for polynomial hashes modulo 2^64 and its inverse, a finishing multiplier.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
FINISH = np.uint64(0xBF58476D1CE4E5B9)
FINISH2 = np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finished 64-bit hash (all bits depend on all bits)."""
    h = (h ^ (h >> np.uint64(30))) * FINISH
    h = (h ^ (h >> np.uint64(27))) * FINISH2
    return h ^ (h >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed)) | np.uint64(1)


_powers: dict[str, np.ndarray] = {}
KEPT_POWERS = 1 << 19  # 8 MB a worker; making 4M powers takes hundredths of a second


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64; a worker keeps ``KEPT_POWERS`` of them, not more."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (BASE, BASE_INVERSE):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            made.append(np.multiply.accumulate(a))
        if size > KEPT_POWERS:
            return made[0][:n], made[1][:n]
        _powers["up"], _powers["down"] = made
    return _powers["up"][:n], _powers["down"][:n]


class RollingHash:
    """Hashes of any byte ranges of one byte array, from prefix sums of value(byte) * BASE^position."""

    VALUES = _byte_values(7)

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.VALUES[data] * up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def flat_bytes(texts: list[bytes], gap: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of many texts with ``gap`` zero bytes after each, and every text's start."""
    data = np.frombuffer((b"\0" * gap).join(texts) + b"\0" * gap, dtype=np.uint8)
    sizes = np.fromiter((len(t) + gap for t in texts), dtype=np.int64, count=len(texts))
    return data, np.cumsum(sizes) - sizes


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A"):ord("Z") + 1] += 32
    return t


#: A-Z to a-z, all other bytes as they are.
LOWER = lower_table()
