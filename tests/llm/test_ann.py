import numpy as np
from pyspark.sql import functions as F

from hourwise.llm import ann
from hourwise.llm.common import read

SF = "/root/testdata/sf0.001"
DDL = "vec_id long, embedding array<float>, score string"


def test_hilbert_neighbours_are_adjacent_cells():
    cells = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    key = ann.hilbert_keys(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, k):
    out = set()
    for q, v in rows:
        if q % 20:
            continue
        own = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q and len(w) == len(v))
        out |= {(q, r + 1, i) for r, (_, i) in enumerate(own[:k])}
    return out


def test_recall_on_small_blocks(spark):
    df = read(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, min_block=16, block_rows=16).collect()
    truth = brute(rows, 20)
    assert len(got) == len(truth)
    assert len({(a, c) for a, _, c in truth} & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(truth)
    by = dict(rows)
    assert all(abs(r.score - float(np.dot(np.float64(by[r.query_id]), np.float64(by[r.vec_id])))) < 1e-12 for r in got)


def test_queries_of_a_block_are_cut_into_parts(spark, monkeypatch):
    seen, cut = [], ann.in_parts

    def watched(asking, asked_of, most):
        out = cut(asking, asked_of, most)
        seen.extend(r["count"] for r in out[0].groupBy("_d", "_c", "_b", "_p").count().collect())
        return out

    monkeypatch.setattr(ann, "in_parts", watched)
    df = read(spark, SF, "embeddings")
    every = F.col("vec_id") % 2 == 0
    whole = ann.nearest(df, every, curves=2, min_block=16, block_rows=16, window=0.5).collect()
    assert not seen
    parts = ann.nearest(df, every, curves=2, min_block=16, block_rows=16, window=0.5, query_rows=10).collect()
    assert sorted(whole) == sorted(parts) and len(whole) > 0
    assert 0 < max(seen) <= 30 and sum(seen) > 10 * max(seen)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (20, [1.0, 0.0], "x"), *[(i, [1.0, 0.0], "x") for i in range(1, 19)], *[(i, [1.0, 0.0], "x") for i in range(21, 39)],
            (40, [0.0, 2.0], None), (41, [0.0, 0.0], "x"), (42, None, "x"), (43, [nan, 1.0], "x"), (44, [inf, 1.0], "x"), (45, [1.0, None], "x"),
            (60, [], "x"), (80, [1.0, 2.0, 3.0], "x"), (100, [3.0, 2.0, 1.0], "x"), (None, [1.0, 1.0], "x"), (46, [0.5, 1.5], "x"), (46, [0.5, 1.5], "x")]
    got = ann.nearest(spark.createDataFrame(rows, DDL), F.col("vec_id") % 20 == 0, k=20).collect()
    ok = [(i, v) for i, v in {(r[0], tuple(r[1]) if r[1] else None): (r[0], r[1]) for r in rows}.values()
          if i is not None and v and None not in v and np.isfinite(np.float64(v)).all() and any(v)]
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == brute(ok, 20)
    assert [r.vec_id for r in got if r.query_id == 80] == [100]  # vectors of another length are never compared
    assert ann.nearest(spark.createDataFrame([], DDL), F.col("vec_id") % 20 == 0).count() == 0
