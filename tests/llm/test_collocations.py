import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourwise.llm import collocations as c

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(t):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(ASCII))]


def brute(docs, longest=3, min_count=10, inside=50):
    """{(lang, phrase): (m, a, l, r, n, score)} of (text, lang) rows."""
    f, n = Counter(), Counter()
    for t, lang in docs:
        for w in pieces(t):
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i:i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    longer = Counter()
    for (lang, p), a in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i:i + m]] = max(longer[lang, p[i:i + m]], a)
    out = {}
    for (lang, p), a in cand.items():
        if 100 * longer[lang, p] >= inside * a and longer[lang, p]:
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang, " ".join(p)] = (len(p), a, l, r, n[lang], score)
    return out


def got(df):
    return {(r.lang, r.phrase): (r.m, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def corpus(seed, rows=60):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "état", "日本", "x y", "state", "new", "york", "a-b", "z" * 40, "\x01"]
    share = rng.dirichlet(np.full(len(words), 0.6))
    seps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "! "]
    made = []
    for i in range(rows):
        w = rng.choice(words, int(rng.integers(0, 60)), p=share)
        made.append(("".join(x + str(rng.choice(seps)) for x in w) + ("new york state " * int(rng.integers(3))), [None, "en", "fr", "und"][i % 4]))
    return made


@pytest.mark.parametrize("ranked", [c.RANKED, (3, 2), (0, 0), (100, 1)])
def test_equals_brute_force_with_and_without_numbers(spark, ranked):
    docs = corpus(1) + [(None, "en"), ("", None), ("...", "de"), ("a b", "es")]
    df = spark.createDataFrame([(t, lang, 1, 2) for t, lang in docs], "text string, lang string, f int, phrase int").repartition(5)
    want = brute(docs, min_count=5)
    assert got(c.collocations(df, min_count=5, ranked=ranked)) == want and len({k[0] for k in want}) == 3 and {v[0] for v in want.values()} == {2, 3}


@pytest.mark.parametrize("ranked", [c.RANKED, (4, 3)])
def test_longer_phrases(spark, ranked):
    docs = corpus(2)
    df = spark.createDataFrame(docs, "text string, lang string")
    assert got(c.collocations(df, longest=4, min_count=4, inside=80, ranked=ranked)) == brute(docs, 4, 4, 80)
    assert got(c.collocations(df, longest=2, min_count=4)) == brute(docs, 2, 4)


def test_rows_without_phrases(spark):
    schema = "text string, lang string"
    for rows in ([], [(None, None)], [("one two", "en")] * 9, [("word", "en")] * 30):
        assert c.top(c.collocations(spark.createDataFrame(rows, schema))).count() == 0
    long_ = "ab cd " * 200000
    r = c.top(c.collocations(spark.createDataFrame([(long_, None)], schema))).collect()
    assert [(x.lang, x["rank"], x.phrase, x.a, x.l, x.r, x.n) for x in r] == [
        ("und", 1, "ab cd ab", 199999, 200000, 199999, 400000), ("und", 2, "cd ab cd", 199999, 200000, 200000, 400000)][:len(r)] or len(r) == 2
    assert got(c.collocations(spark.createDataFrame([(long_, None)], schema))) == brute([(long_, None)])


def test_ranks_are_in_order(spark):
    docs = corpus(3)
    rows = c.top(c.collocations(spark.createDataFrame(docs, "text string, lang string"), min_count=4), 7).collect()
    want = brute(docs, min_count=4)
    for lang in ("en", "fr", "und"):
        order = sorted((k for k in want if k[0] == lang), key=lambda k: (-want[k][5], -want[k][1], k[1].encode()))[:7]
        assert [r.phrase for r in sorted((r for r in rows if r.lang == lang), key=lambda r: r["rank"])] == [k[1] for k in order]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=400), st.sampled_from([2, 4, 16]), st.sampled_from([1, 50, 10**6]))
def test_tiles_count_cells(pairs, tile, buffer):
    t, seen = c.Tiles(tile, buffer), Counter()
    cells = np.array([(a << c.SHIFT) + b for a, b in pairs], dtype=np.int64)
    made = [x for part in np.array_split(cells, 3) for x in t.add(part)] + list(t.counts())
    for cell, n in made:
        assert len(set(cell.tolist())) == len(cell)
        for k, v in zip(cell.tolist(), n.tolist()):
            seen[k] += v
    assert seen == Counter(cells.tolist())


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 123456789012, 987654321098, 456789012345
    row = spark.range(1).select(c.score(F.lit(a), F.lit(l), F.lit(r)).alias("s")).first()
    assert row.s == 10**6 * a * a // (l * r)


def test_marks_cover_their_phrases(spark):
    df = spark.createDataFrame([("a b",), ("état x",), ("q" * 300 + " y",)], "phrase string")
    marks = c.Level(marks=c.marks_of(df))
    w = c.Words(["a b. état x".encode(), ("q" * 300 + " y").encode(), b"b a"])
    pairs = np.flatnonzero(w.follows)
    assert marks.marked(c.phrase_hash([w.hash[pairs - 1], w.hash[pairs]])).tolist() == [True, True, True, False]
    assert w.text == pa.array(["a", "b", "état", "x", "q" * 300, "y", "b", "a"], pa.large_string())
