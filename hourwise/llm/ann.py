"""Operator 2, approximate nearest neighbours: shifted space-filling curves.

Nearness is the largest inner product.  Vectors get one more component that brings all to the largest norm M (queries
are scaled to M instead), so nearness becomes distance.  For each of ``curves`` orderings the vectors are projected on
``axes`` random orthonormal directions, mapped to (0, 1) by the normal distribution, shifted by a random amount and
quantised; a Hilbert key orders them.  Spark range-partitions and sorts all (curve, key) rows; a row's rank follows
from its place in its partition and the sizes of the partitions before, and ranks are cut into blocks of at most
``block_rows``.  A query visits its own block and the neighbouring ones of its window, in every curve; what the
windows find is merged and reranked by the exact inner product in double precision.

Equal vectors are indexed once, with their k + 1 smallest ids: no result of k rows can hold more of them.

The window is a share of all rows (``window``), since the recall of locality-preserving orders on vectors without
cluster structure follows the share that is looked at; figures are in the README.  Memory of a task is bounded on both
sides: by blocks of candidates, and by parts of about ``query_rows`` of the queries that visit a block.

Defined results: null vectors, null ids, empty or zero vectors and those with null or non-finite components take no
part; vectors of another length are never compared; fewer candidates than k: all of them; equal scores: smaller id
first; an id in several rows is one candidate for each different vector; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, read, stored

SEED = 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (axes columns, ``bits`` bits each): bitwise, over all rows at once."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = x[0] ^ np.where(set_, low, swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t = np.where((x[-1] & (1 << level)) != 0, t ^ ((1 << level) - 1), t)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> level) & 1)
    return key


@lru_cache(maxsize=256)
def curve_axes(dim: int, curve: int, axes: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal directions (dim + 1, axes) and shifts of one curve."""
    rng = np.random.Generator(np.random.Philox(key=[SEED, dim * 1000 + curve]))
    q, _ = np.linalg.qr(rng.standard_normal((dim + 1, min(axes, dim + 1))))
    return q, rng.random(q.shape[1])


def uniform(y: np.ndarray) -> np.ndarray:
    """Standard normal values to (0, 1), monotone (logistic form of the distribution function)."""
    return 1.0 / (1.0 + np.exp(np.clip(-1.702 * y, -50, 50)))


def valid(v: Column) -> Column:
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ok & F.exists(v, lambda x: x != 0)


def in_parts(asking: DataFrame, asked_of: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Queries and candidates with ``_p`` and ``part``: the queries of every block are dealt by their hash into as many
    parts as the most visited block needs for about ``most`` in each; candidates are repeated for each part."""
    visitors = asking.groupBy("_d", "_c", "_b").count().agg(F.max("count")).first()[0] or 0
    n = max(1, ceil(visitors / most))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    return asking.withColumn("_p", F.pmod("h", F.lit(n).cast("long"))), asked_of.withColumn("part", each)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            curves: int = 16, axes: int = 8, bits: int = 7, window: float = 0.1, block_rows: int = 8192,
            min_block: int = 512, query_rows: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row for which ``queries`` (a condition on the id) holds."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("raw"), queries.alias("q")).where(F.col("id").isNotNull() & valid(F.col("raw")))
    rows = rows.select("id", F.transform("raw", lambda x: x.cast("double")).alias("v"), F.coalesce("q", F.lit(False)).alias("q"))
    rows = rows.withColumn("h", F.xxhash64("v"))
    distinct_ids = rows.groupBy("h", "v", "id").agg(F.max("q").alias("q"))
    first = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    members = distinct_ids.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = distinct_ids.where("q").select(F.col("h").alias("_h"), F.col("v").alias("_v")).distinct().withColumn("_q", F.lit(True))
    index = members.join(asked, (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")), "left").select(
        "h", "v", "ids", F.col("ids")[0].alias("first"), F.coalesce("_q", F.lit(False)).alias("q"))
    index = stored(index, "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    total, largest, queries_in_all = index.agg(F.count("*"), F.max(norm), F.count_if("q")).first()
    block = max(min_block, min(block_rows, ceil(total / 50)))
    reach = ceil(window * total / 2 / block)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            dims = np.diff(col.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == dim)) if len(np.unique(dims)) > 1 else b
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                size = np.sqrt((x * x).sum(axis=1, keepdims=True))
                own = np.hstack([x, np.sqrt(np.maximum(0.0, largest * largest - size * size))])
                for c in range(curves):
                    directions, shift = curve_axes(dim, c, axes)
                    u = uniform(own @ directions * (np.sqrt(dim + 1) / largest))
                    cells = np.minimum(((u + shift) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), dim, np.int32)), pa.array(np.full(len(x), c, np.int32)), pa.array(hilbert_keys(cells, bits)),
                         *[part.column(n) for n in ("h", "first", "q", "ids", "v")]], ["dim", "curve", "key", "h", "first", "q", "ids", "v"])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            names = list(zip(b.column("dim").to_pylist(), b.column("curve").to_pylist()))
            pos = []
            for n in names:
                seen[n] = seen.get(n, -1) + 1
                pos.append(seen[n])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(pos), part, np.int32)), pa.array(pos, pa.int64())], [*b.schema.names, "part", "pos"])

    schema = "dim int, curve int, key long, h long, first long, q boolean, ids array<long>, v array<double>"
    parts = max(1, ceil(total * curves / max(block, 20_000)))
    order = ("dim", "curve", "key", "h", "first")
    curve_rows = index.mapInArrow(keyed, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(curve_rows.mapInArrow(numbered, schema + ", part int, pos long"), "curves")
    counts = placed.groupBy("dim", "curve", "part").agg(F.count("*").alias("n"))
    by = Window.partitionBy("dim", "curve").orderBy("part")
    before = counts.select(*[F.col(c).alias(f"_{c}") for c in ("dim", "curve", "part")],
                           F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("of"))
    same = (F.col("dim") == F.col("_dim")) & (F.col("curve") == F.col("_curve")) & (F.col("part") == F.col("_part"))
    ranked = placed.join(before, same).withColumn("block", F.floor((F.col("before") + F.col("pos")) / block))
    ranked = ranked.withColumn("last", F.floor((F.col("of") - 1) / block))
    visits = F.sequence(F.greatest(F.lit(0).cast("long"), F.col("block") - reach), F.least(F.col("last"), F.col("block") + reach))
    asking = ranked.where("q").select(F.col("dim").alias("_d"), F.col("curve").alias("_c"), F.explode(visits).alias("_b"), "h", "first", F.col("v").alias("_w"))
    asked_of = ranked.select("dim", "curve", "block", "ids", "v")
    if queries_in_all > query_rows:
        asking, asked_of = in_parts(asking, asked_of, query_rows)
    else:
        asking, asked_of = asking.withColumn("_p", F.lit(0).cast("long")), asked_of.withColumn("part", F.lit(0).cast("long"))

    def best(key, queries_: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(queries_) or not len(own):
            return queries_[["h", "first"]].iloc[:0].assign(ids=pd.Series(dtype=object), scores=pd.Series(dtype=object))
        x, y = np.stack(queries_["_w"].to_numpy()), np.stack(own["v"].to_numpy())
        ids = own["ids"].to_numpy()
        out_ids, out_scores = [], []
        m = min(k + 1, len(y))
        for a in range(0, len(x), 512):
            s = x[a:a + 512] @ y.T
            near = np.argpartition(-s, m - 1, axis=1)[:, :m]
            worst = np.take_along_axis(s, near, 1).min(axis=1)
            for i, w in enumerate(worst):
                at = np.flatnonzero(s[i] >= w - 1e-12 * abs(w))  # all ties of the last one
                exact = (x[a + i] * y[at]).sum(axis=1)
                found = sorted((-e, j) for e, c in zip(exact.tolist(), at.tolist()) for j in ids[c])[:k + 1]
                out_ids.append([j for _, j in found])
                out_scores.append([-e for e, _ in found])
        return pd.DataFrame({"h": queries_["h"], "first": queries_["first"], "ids": out_ids, "scores": out_scores})

    found = asking.groupBy("_d", "_c", "_b", "_p").cogroup(asked_of.groupBy("dim", "curve", "block", "part")).applyInPandas(best, "h long, first long, ids array<long>, scores array<double>")
    each = found.select("h", "first", F.explode(F.arrays_zip("ids", "scores")).alias("x")).groupBy("h", "first", F.col("x.ids").alias("id")).agg(F.max("x.scores").alias("score"))
    place = F.row_number().over(Window.partitionBy("h", "first").orderBy(F.desc("score"), "id"))
    top = each.withColumn("n", place).where(F.col("n") <= k + 1).select("h", "first", F.col("id").alias("vec_id"), "score")
    who = distinct_ids.where("q").select(F.col("id").alias("query_id"), F.col("h").alias("_h"), F.col("v").alias("_v"))
    keys = index.where("q").select(F.col("h").alias("_h2"), F.col("first").alias("_first"), F.col("v").alias("_v2"))
    who = who.join(keys, (F.col("_h") == F.col("_h2")) & (F.col("_v") == F.col("_v2"))).select("query_id", "_h", "_first")
    answers = who.join(top, (F.col("_h") == F.col("h")) & (F.col("_first") == F.col("first"))).where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
