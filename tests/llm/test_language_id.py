import itertools

import numpy as np

from hourwise.llm import lang_id
from hourwise.llm.common import read

SF = "/root/testdata/sf0.001"


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    for n, k in ((1, 3), (5, 2), (6, 3)):
        score = -rng.random((n, k)).astype(np.float32) * 5
        best = max(itertools.product(range(k), repeat=n),
                   key=lambda p: sum(score[i, s] for i, s in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:])))
        assert lang_id.viterbi(score, np.array([0]), np.array([n]), 2.0).tolist() == list(best)


def test_texts_of_different_length_advance_together():
    rng = np.random.default_rng(4)
    score = -rng.random((12, 2)).astype(np.float32) * 5
    count = np.array([3, 0, 7, 2])
    first = np.cumsum(count) - count
    together = lang_id.viterbi(score, first, count, 1.5)
    for f, c in zip(first, count):
        if c:
            assert together[f:f + c].tolist() == lang_id.viterbi(score[f:f + c], np.array([0]), np.array([c]), 1.5).tolist()


def model(spark):
    docs = read(spark, SF, "documents")
    return lang_id.fit(docs, where=~lang_id.held_out())


def test_held_out_accuracy_and_edge_cases(spark):
    m = model(spark)
    docs = read(spark, SF, "documents")
    out = lang_id.label(docs.where(lang_id.held_out()), m).selectExpr("_row.lang AS lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    en = docs.where("lang = 'en'").first().text
    fr = docs.where("lang = 'fr'").first().text
    en, fr = " ".join(en.split()[:60]), " ".join(fr.split()[:40])
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 .. !", "x"), (4, en + " " + fr, "x"), (4, en + " " + fr, "x"), (None, fr, None), (6, "ab " * 40000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")  # score clashes with a result column
    got = lang_id.label(df, m).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3 and got[0].spans == []
    mixed = got[3]
    assert mixed.lang_pred == "en" and 0.5 < mixed.score < 0.9 and mixed == got[4]
    assert [s.lang for s in mixed.spans] == ["en", "fr"] and abs(mixed.spans[1].start - len(en) - 1) < 40
    assert got[5].lang_pred == "fr" and got[5]._row.score is None
    assert lang_id.label(df.limit(0), m).count() == 0


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, l) for i in range(20) for t, l in (("привет мир как дела", "ru"), ("hello world how are you", "en"), ("shalom שלום עולם", "he"))]
    m = lang_id.fit(spark.createDataFrame([(10 * i + j, t, l) for j, (i, t, l) in enumerate(rows)], "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, "мир"), (2, "שלום"), (3, "are you")], "doc_id long, text string")
    assert [r.lang_pred for r in lang_id.label(df, m).collect()] == ["ru", "he", "en"]


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    r = lang_id.label(df, lang_id.fit(df)).first()
    assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])


def test_labels_of_held_out_rows_do_not_matter(spark):
    df = read(spark, SF, "documents").selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(string(doc_id)), 3) = 1 THEN 'xx' ELSE lang END AS lang")
    assert "xx" not in lang_id.fit(df, where=~lang_id.held_out()).langs
