import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourwise.llm import toxicity as m
from hourwise.llm.common import read


def test_sentences_and_their_places():
    texts = ["", "One two. THREE!  four\nfive", "...", "是的。不是", "no end"]
    s = m.Sentences(texts)
    assert s.count.tolist() == [0, 4, 0, 2, 1]
    assert [texts[t][a:b] for t, a, b in zip(s.text, s.start, s.end)] == ["One two", "THREE", "four", "five", "是的", "不是", "no end"]


def grams(word):
    p = f"^{word}$"
    return {p[i:i + n] for n in m.GRAMS for i in range(len(p) - n + 1)} | {"whole " + word}


def test_features_are_grams_of_single_words():
    """Equal words have equal features wherever they stand; the number of features is that of distinct grams."""
    s = m.Sentences(["Stupid thing", "a stupid. thing stupid", "stupid"])
    owner, cell = m.distinct(*s.features(), m.CELLS)
    of = [set(cell[owner == i].tolist()) for i in range(4)]
    assert len(of[3]) == len(grams("stupid")) and len(of[0]) == len(grams("stupid") | grams("thing")) and of[0] == of[2]
    assert of[0] & of[1] == of[3] and len(of[1]) == len(grams("a") | grams("stupid"))


def test_gradient_equals_differences():
    rng = np.random.default_rng(5)
    size, feature = [[2, 1], [], [3], [1]], [[0, 2, 1], [], [0, 1, 3], [2]]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 0, 0, 1]), pa.array([1, 1, 0, 4]), pa.array(size, pa.list_(pa.int64())), pa.array(feature, pa.list_(pa.int64()))],
                                       ["y", "empty", "size", "feature"])
    x = np.append(rng.normal(size=4), -1.0)

    def loss(x):
        total = 0.0
        for y, empty, sizes, f in zip([1, 0, 0, 1], [1, 1, 0, 4], size, feature):
            at = np.cumsum([0, *sizes])
            z = [x[4]] * empty + [x[4] + sum(x[k] for k in f[a:b]) for a, b in itertools.pairwise(at)]
            p = 1 - np.prod([1 - 1 / (1 + np.exp(-v)) for v in z])  # noisy-or
            total -= 3.0 * np.log(p) if y else 0.5 * np.log(1 - p)
        return total

    g = m.gradient(batch, x[:4], x[4], (0.5, 3.0))
    assert g[-1] == pytest.approx(loss(x))
    for k in range(5):
        e = np.eye(5)[k] * 1e-6
        assert g[k] == pytest.approx((loss(x + e) - loss(x - e)) / 2e-6, rel=1e-5, abs=1e-8)


WORDS = ["river", "stone", "window", "garden", "paper", "silver", "morning", "bread", "yellow", "market"]
BAD = ["blorkface", "grumbleworm", "zotbrain"]


def corpus(n=400, seed=1):
    """Every fourth document holds one offending sentence among others; (id, text, offending sentence, toxic)."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(WORDS, 6)) for _ in range(int(rng.integers(1, 30)))]
        bad = None
        if i % 4 == 0:
            bad = f"{rng.choice(WORDS)} {rng.choice(BAD)}s {rng.choice(WORDS)}"
            parts.insert(int(rng.integers(len(parts) + 1)), bad)
        rows.append((i, ". ".join(parts) + ".", bad, int(bad is not None)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 9.0) for i, t, _, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y, "x") for i, _, _, y in rows], "doc_id long, toxic int, text string")
    return docs, labels, m.fit(docs, labels, where=~m.held_out(F.col("_key")))


def test_held_out_documents_and_offending_sentences(spark, fitted):
    docs, _, model = fitted
    bad = {i: b for i, _, b, _ in corpus()}
    got = m.scored(docs, model).where(m.held_out(F.col("_row.doc_id"))).collect()
    assert len(got) > 50
    for r in got:
        want = bad[r._row.doc_id]
        assert (r.score >= 0.5) == (want is not None) and 0 <= r.score <= 1 and r._row.score == 9.0
        assert [r._row.text[s.start:s.end] for s in r.offending] == ([want] if want else [])


def test_edge_cases(spark, fitted):
    model = fitted[2]
    long_ = "river stone. " * 150000 + "you zotbrain."
    rows = [(1, None), (2, ""), (3, "?!"), (None, "You ZOTBRAINS"), (4, "river " * 5), (4, "river " * 5), (5, long_)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = m.scored(df, model).collect()
    assert got[0].score == got[1].score == got[2].score < 0.5 and got[0].n_sentences == 0 and got[0].offending == []
    assert got[3].score > 0.5 and got[4] == got[5] and got[4].score < 0.5
    assert [(s.start, s.end) for s in got[6].offending] == [(len(long_) - 13, len(long_) - 1)]
    assert m.scored(df.limit(0), model).count() == 0
    assert [s.score for s in m.scored(df, model).select(F.explode("offending.score").alias("score")).collect()] == [s.score for r in got for s in r.offending]


def test_scores_do_not_depend_on_neighbours(fitted):
    model = fitted[2]
    texts = [t for _, t, _, _ in corpus(60, 2)]
    table = model.table()
    assert m.score_texts(texts, model, table, 0.5) == [m.score_texts([t], model, table, 0.5)[0] for t in texts]


def test_little_to_learn_from(spark, fitted):
    docs, labels, _ = fitted
    none = labels.where("toxic IS NULL")
    for of, constant in ((none, 0.0), (labels.where("toxic = 1"), 1.0), (labels.where("toxic = 0"), 0.0)):
        model = m.fit(docs, of)
        assert {r.score for r in m.scored(docs, model).select("score").collect()} == {constant}
    nameless = labels.select(F.lit(None).cast("long").alias("doc_id"), "toxic")
    assert m.fit(docs, nameless).constant == 0.0
    assert m.fit(docs.limit(0), labels).constant == pytest.approx(0.25)  # labels without documents: the base rate
    twice = labels.unionByName(labels.withColumn("toxic", F.lit(None).cast("int"))).unionByName(labels)
    assert m.fit(docs, twice, steps=2).weights.tolist() == m.fit(docs, labels, steps=2).weights.tolist()


def test_labels_of_held_out_rows_do_not_matter(spark, fitted):
    docs, labels, model = fitted
    flipped = labels.withColumn("toxic", F.when(m.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = m.fit(docs, flipped, where=~m.held_out(F.col("_key")))
    assert again.cells.tolist() == model.cells.tolist() and again.weights.tolist() == model.weights.tolist()


def test_query_on_the_given_tables(spark):
    """Held-out accuracy: some of these labels are of documents without any offending word, so the bound is low here."""
    sf = "/root/testdata/sf0.01"
    out = m.op12_toxicity(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out")
    rows = out.select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert out.where("score < 0 OR score > 1 OR predicted != int(score >= 0.5)").isEmpty()
