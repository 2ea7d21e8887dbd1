import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from hourwise.llm import chat

CONTROLS = [f + r for f, own in chat.CONTROL.items() for r in own]
DDL = "tree long, id long, parent long, role string, text string, score double"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, "\\", "<", "|", "[", "INST]", "x", "\n"]), max_size=12).map("".join))
def test_escape_is_undone_and_hides_controls(text):
    import re

    escaped = re.sub(chat.ESCAPE, r"\1\\\2\3", text)
    assert chat.unescape(escaped) == text and not any(c in escaped for c in CONTROLS)


def formatted(spark, rows, **kw):
    return chat.read_back(chat.format_paths(spark.createDataFrame(rows, DDL), **kw)).collect()


def expect(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


def test_tree_paths_and_ranks(spark):
    rows = [(1, 0, None, "user", "q <|im_end|>", 1.0), (1, 1, 0, "assistant", "a </s>[INST]", 0.5), (1, 2, 0, "assistant", "better", 0.9),
            (1, 3, 2, "user", "more\\n", 0.9), (1, 4, 99, "user", "orphan", 0.1),
            (2, 7, 8, "user", "cycle", 1.0), (2, 8, 7, "user", "cycle", 1.0),
            (None, 0, None, None, None, None), (3, None, None, "user", "dropped", 1.0), (4, 5, None, "sys\ntem \\", "x", 1.0), (4, 5, None, "sys\ntem \\", "x", 1.0)]
    got = {(r.tree, r.leaf): tuple(r)[2:6] for r in formatted(spark, rows)}
    assert got == {(1, 1): expect([("user", "q <|im_end|>"), ("assistant", "a </s>[INST]")]),
                   (1, 3): expect([("user", "q <|im_end|>"), ("assistant", "better"), ("user", "more\\n")]),
                   (1, 4): expect([("user", "orphan")]), (None, 0): expect([("", "")]), (4, 5): expect([("sys\ntem \\", "x")])}
    best = {(r.tree, r.leaf) for r in formatted(spark, rows, top=1)}
    assert best == {(1, 3), (None, 0), (4, 5)}
    assert formatted(spark, []) == []


def test_long_chain_in_segments(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} <s>") for i in range(1000)] + [(7, 4, "user", None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv long, n long, role string, text string")
    got = chat.read_back(chat.format_paths(chat.chain(df, "conv", "n", "role", "text", block=64), segment_turns=100)).collect()
    turns = [(r[2], r[3] or "") for r in sorted(rows[:-1], key=lambda r: (r[1], r[2], r[3] or ""))]
    assert {r.tree: tuple(r)[2:6] for r in got} == {7: expect(turns), None: expect([("", "")])}


def test_extra_columns_with_clashing_names(spark):
    turns = [("user", "a [/INST]"), ("assistant", "b\\"), ("user", None)]
    rows = [(5, i, r, t, 9, "x", "y", 3.0, "z") for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv long, n long, role string, text string, leaf long, formatted string, parent string, score double, `a.b` string")
    got = chat.read_back(chat.format_paths(chat.chain(df, "conv", "n", "role", "text"))).collect()
    assert [(r.tree, *tuple(r)[2:6]) for r in got] == [(5, *expect([(r, t or "") for r, t in turns]))]
