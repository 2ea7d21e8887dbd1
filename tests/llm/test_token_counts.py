import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourwise.llm import token_counts as t

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tools():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    own.encode_special_tokens = True
    return t.Lengths(open(t.VOCABULARY, "rb").read()), own


def test_spans_equal_the_other_library(spark, tools):
    for text in [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()] + ["naïve 日本 😀 x", "a\x1cb  c　 d", "   ", "<|endoftext|>"]:
        start, end = t.char_spans(text, tools[0](text))
        assert list(zip(start.tolist(), end.tolist())) == tools[1].encode(text, add_special_tokens=False).offsets or len(start) == len(tools[1].encode(text, add_special_tokens=False).ids)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_token_number_equals_the_other_library(text):
    from tokenizers import Tokenizer

    if "own" not in _kept:
        _kept["own"] = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
        _kept["own"].encode_special_tokens = True
        _kept["len"] = t.Lengths(open(t.VOCABULARY, "rb").read())
    assert len(_kept["len"](text)) == len(_kept["own"].encode(text, add_special_tokens=False).ids)


_kept: dict = {}


def test_long_runs(tools):
    for text in (" " * 300_000, "a" * 300_000, "\n" * 200_000 + "x", "é" * 100_000):
        assert int(tools[0](text).astype(np.int64).sum()) == len(text.encode())


def test_rules():
    start, end = np.array([0, 3, 6]), np.array([3, 6, 9])
    assert t.allocate(start, end, [(0, 4), (4, 9)], 9, "most")[0].tolist() == [1, 2, 0]
    assert t.allocate(start, end, [(0, 4), (4, 9)], 9, "first")[0].tolist() == [2, 1, 0]
    assert t.allocate(start, end, [(1, 2)], 9, "most") [0].tolist() == [0, 3]
    assert t.allocate(np.array([0]), np.array([2]), [(0, 1), (1, 2)], 2, "most")[0].tolist() == [1, 0, 0]  # a tie: the earlier
    assert t.allocate(np.array([], int), np.array([], int), [], 0, "most") == (pytest.approx(np.array([0])), 0)


def test_edge_cases(spark):
    rows = [(1, None, None, None, 9), (2, "s", "en", "Hello world", 9), (2, "s", "en", "Hello world", 9), (None, "", "", "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string, n_tokens int")
    got = t.count_tokens(df).collect()
    assert [sum(r.tokens) == r.n_tokens for r in got] == [True] * 4 and got[1] == got[2]
    assert got[0].tokens[:3] == [0, 0, 0] and got[1].tokens[2] >= 2
    assert t.count_tokens(df.limit(0)).count() == 0
    marked = spark.createDataFrame([("Hello world again", [(0, 5), (5, 11)]), ("x", None)], "text string, s array<struct<start:int,end:int>>")
    assert [r.tokens for r in t.count_tokens(marked, fields=("text",), sections="s").collect()] == [[1, 1, 1], [1]]
