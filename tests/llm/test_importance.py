import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourwise.llm import importance as m
from hourwise.llm.common import read

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def words(t):
    return WORD.findall((t or "").translate(ASCII))


def buckets(t):
    w = words(t)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5, min_words=20):
    """[(id, n_features, weight, score, rank)] in the order of ``docs``."""
    own = [buckets(t) for _, t in docs]
    s, t = np.zeros(10000), np.zeros(10000)
    np.add.at(s, [x for b in own for x in b], 1)
    np.add.at(t, [x for y in target for x in buckets(y)], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s, t)]
    rows = []
    for (i, x), b in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in b)
        rows.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((k for k in range(len(rows)) if len(words(docs[k][1])) >= min_words),
                 key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    for rank, k in enumerate(may[:percent * len(may) // 100], 1):
        rows[k][4] = rank
    return [tuple(r) for r in rows]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


piece = st.tuples(st.sampled_from(["a", "B", "word", "É", "日本語", "x1", "long" * 20, "\x80"]), st.sampled_from([" ", ", ", "\n", "--", "\x7f"]))
text = st.lists(piece, max_size=30).map(lambda p: "".join(a + b for a, b in p))


@settings(max_examples=100, deadline=None)
@given(st.lists(text, min_size=1, max_size=5))
def test_features_equal_plain_checksums(texts):
    n, found = m.features([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert n[i] == len(words(t))
        assert [b for of, bucket in found for b in bucket[of == i].tolist()] == buckets(t)


def test_long_words_and_segments():
    t = "y" * 70 + " " + "z" * 5000 + " q " + "é" * 40 + " k"
    assert [b for of, x in m.features([t.encode()])[1] for b in x.tolist()] == buckets(t)
    t = b"ab cd  efgh ij" * 50 + b"x" * 30
    assert (m.word_offsets(t, segment=7) == m.word_offsets(t)).all()


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in read(spark, SF, "benchmark").collect()]
    got = [tuple(r) for r in m.op13_importance(spark, SF).collect()]
    assert order(got) == order(brute(docs, target))
    assert sum(r[4] is not None for r in got) == sum(len(words(t)) >= 20 for _, t in docs) * 5 // 100 > 0


LONG = "some words of a target text that is of interest here " * 3
ROWS = [(1, None), (2, ""), (3, "..!"), (4, "too short"), (5, LONG), (5, LONG), (None, LONG), (None, LONG + "more"), (6, "x " * 60000), (7, LONG.upper())]


@pytest.mark.parametrize("target", [["target text of interest", None, ""], []])
def test_edge_cases(spark, target):
    rows = ROWS + [(100 + i, f"filler {i} " * 12) for i in range(30)]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, rank int")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    out = m.resampled(docs, aim, percent=50)
    got = [tuple(r) for r in out.selectExpr("_row.doc_id", "n_features", "weight", "score", "rank").collect()]
    assert order(got) == order(brute(rows, target, percent=50))
    assert out.selectExpr("_row.score").distinct().collect()[0][0] == 1.0  # a column of the same name rides along
    assert m.resampled(docs.limit(0), aim).count() == 0


def test_many_equal_rows_get_different_ranks(spark):
    docs = spark.createDataFrame([(None, LONG)] * 300, "doc_id long, text string")
    got = m.resampled(docs, docs.limit(1), percent=40).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 121)) and len(got) == 300
