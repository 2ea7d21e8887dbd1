import random
import re

import pytest
from pyspark.sql import functions as F

from hourwise.llm import substring


def brute(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]] = seen.get(d[p:p + length], 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = [True] * length
        out.append((len(d), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), bytes(b for b, g in zip(d, gone) if not g)))
    return out


def check(spark, texts, length=80, core=48):
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ranges string")
    out = substring.cut(df, substring.repeated_starts(df, length=length, core=core), length=length)
    got = sorted((r._row.text is not None, r._row.text or "", r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect())
    assert got == sorted((t is not None, t or "", *b) for t, b in zip(texts, brute(texts, length)))


def test_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(40), prose(25), prose(60)]
    texts = [None, "", "short", "short", "ab" * 300, "a" * 500, "a" * 79, "xyz" * 27, prose(200), *["same " + shared[0]] * 4]
    for _ in range(60):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, 40)
            parts += [s[a:a + rng.randint(60, 300)], prose(rng.randint(0, 12))]
        texts.append(" ".join(parts))
    check(spark, texts)


def test_segments_of_long_texts(spark, monkeypatch):
    import numpy as np

    data = np.frombuffer(b"0123456789" * 40, dtype=np.uint8)
    monkeypatch.setattr(substring, "SEGMENT", 100)
    assert [(a, len(d)) for a, d in substring.segments(data, 80)] == [(0, 179), (100, 179), (200, 179), (300, 100)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.cut(df, substring.repeated_starts(df)).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert substring.cut(one, substring.repeated_starts(one)).select("n_bytes", "n_removed", F.length("kept")).collect() == [(0, 0, 0)]


def test_shared_passage_of_over_fifty_words_goes_from_400_bytes_on(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows, passages = [], {}
    for size in (394, 399, 400):
        passages[size] = prose(80)[:size - 2] + "zz"  # ends in a letter, whatever was cut
        assert len(passages[size].split()) > 50
        rows += [(size, f"{prose(30)}{c}{passages[size]}{c.upper()}{prose(30)}") for c in "xy"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.cut(df, substring.repeated_starts(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        size, text = r._row.doc_id, r._row.text
        left = text.replace(passages[size], "") if size >= 400 else text
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(text), len(text) - len(left), int(size >= 400), left.encode())


def brute_shared(texts, size):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    holders = {}
    for i, w in enumerate(words):
        for p in range(len(w) - size + 1):
            holders.setdefault(tuple(w[p:p + size]), set()).add(i)
    out = []
    for w in words:
        in_run = set()
        for p in range(len(w) - size + 1):
            if len(holders[tuple(w[p:p + size])]) > 1:
                in_run.update(range(p, p + size))
        out.append(len(in_run))
    return out


@pytest.mark.parametrize("chunk, segment", [(2 << 20, 1 << 19), (300, 7)])
def test_words_shared_by_documents_equal_brute_force(spark, monkeypatch, chunk, segment):
    monkeypatch.setattr(substring, "CHUNK", chunk)
    monkeypatch.setattr(substring, "WORD_SEGMENT", segment)
    rng = random.Random(3)
    prose = lambda n: [rng.choice("abcdeé") * rng.randint(1, 3) for _ in range(n)]
    shared = [prose(40), prose(25), prose(60)]
    texts = [None, "", "a", "one two", "o " * 90, "u " * 90, "x y z " * 30, *[" ".join(prose(30))] * 3, " ".join(prose(15) * 3)]
    for i in range(60):
        parts = prose(rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            s, a = rng.choice(shared), rng.randint(0, 30)
            parts += s[a:a + rng.randint(8, 50)] + prose(rng.randint(0, 4))
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    want = brute_shared(texts, 12)
    assert sum(0 < n < len(t.split()) for t, n in zip(texts, want) if t) > 20
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = substring.cut(df, substring.repeated_starts(df, words=12, word_core=5))
    assert {r.doc_id: r.n_shared_words for r in out.select("_row.doc_id", "n_shared_words").collect()} == dict(enumerate(want))


def test_shared_passages_of_over_fifty_words_and_under_400_bytes_are_counted(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = {n: prose(n) for n in (50, 51, 59)}
    rows = [(n, f"{prose(30)} {c}{n} {passages[n]} {n}{c} {prose(30)}") for n in passages for c in "xy"]
    twice = prose(55)
    rows += [(1, f"{twice} once {twice}"), (2, twice[:200]), (2, twice[:200])]  # inside one document; copies of under 51 words
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring.cut(df, substring.repeated_starts(df)).select("_row.doc_id", "n_removed", "n_shared_words").collect()
    assert sorted(got) == sorted((n, 0, n if n > 50 else 0) for n, _ in rows)
