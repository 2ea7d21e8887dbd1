import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hourwise.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(ASCII))


def brute(text, items, window=13):
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        x = words(t)
        for a in range(max(1, len(x) - window + 1)) if x else ():
            p = x[a:a + window]
            for b in range(len(w) - len(p) + 1):
                if w[b:b + len(p)] == p:
                    hit |= set(range(b, b + len(p)))
                    ids |= {str(i)} if i is not None else set()
    return len(w), len(hit), sorted(ids)


vocab = st.sampled_from(["a", "b", "C", "É", "x1", "the", "日本"])
text = st.lists(st.tuples(vocab, st.sampled_from([" ", ", ", "\n", "--"])), max_size=60).map(lambda p: "".join(a + b for a, b in p))


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=5), st.lists(text, max_size=5))
def test_search_equals_brute_force(texts, items):
    patterns = {}
    for i, t in enumerate(items):
        x = words(t)
        for a in range(max(1, len(x) - 12)) if x else ():
            patterns.setdefault(" ".join(x[a:a + 13]), set()).add(str(i))
    s = d.Searcher(list(patterns), [sorted(v) for v in patterns.values()])
    for t, (n, hits, ids) in zip(texts, s.search([t.encode() for t in texts])):
        assert (n, sum(b - a for a, b in hits), sorted(ids)) == brute(t, list(enumerate(items)))


PASSAGE = " ".join(f"w{i}" for i in range(20))
ITEMS = [(2, PASSAGE), (10, "Short item"), (10, "other row of ten " + PASSAGE), (None, "nameless thing"), (5, None), (6, " ... "), (7, "zz")]
DOCS = [(1, None), (2, ""), (3, "!!"), (4, "before " + PASSAGE.upper() + " after"), (4, "before " + PASSAGE.upper() + " after"), (None, "a SHORT, item; nameless thing"),
        (8, "filler " * 40000 + PASSAGE), (9, "w1 w2 w3")]


def check(spark, **kw):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, items string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = d.judged(d.find_windows(docs, bench, **kw)).selectExpr("_row.doc_id", "_row.text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert len(got) == len(DOCS)
    for r in got:
        n, hit, ids = brute(r.text, ITEMS) if r.text is None or len(r.text) < 1000 else (40020, 20, ["10", "2"])
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


def test_edge_cases(spark):
    check(spark)


def test_patterns_in_many_blocks_give_the_same(spark):
    check(spark, block_bytes=600)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.judged(d.find_windows(docs, none)).where("n_hit > 0 OR contaminated").count() == 0
    assert d.find_windows(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
