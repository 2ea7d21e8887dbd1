import corpus_pipeline as p

from hourwise.llm import lang_id, pii
from hourwise.llm.common import read

from test_decontaminate import brute as contaminated
from test_near_dup import brute as groups

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    columns, now = docs.columns, rows(docs)
    model = lang_id.fit(docs, where=~lang_id.held_out())
    out = [docs]
    for name, stage in p.STAGES:
        before, df = now, stage(spark, out[-1], SF)
        now = rows(df)
        if name != "mixing":
            assert df.columns == columns
        if name == "language_id":
            found = dict(zip(before, lang_id.label_texts([r.text or "" for r in before.values()], model, 12.0, 8.0)))
            assert set(now) == {i for i, (_, lang, _) in found.items() if lang != "und"} and len(now) >= 0.97 * len(before)
        if name == "near_dedup":
            own = sorted((i, r.text) for i, r in before.items())
            assert set(now) == {i for (i, _), (n, c) in zip(own, groups(own, 5, 80)) if not n or i == c}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
            judged = {i: contaminated(r.text, items) for i, r in before.items()}
            assert set(now) == {i for i, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)}
        if name == "pii":
            assert set(now) == set(before)
            assert all(r.text == pii.redact(before[i].text) and r.n_chars == len(r.text) for i, r in now.items())
            assert not any(k in pii.BASE_KINDS for r in now.values() for _, _, k in pii.find(r.text))
        if name == "mixing":
            assert set(now) == set(before) and abs(sum(r.taken for r in now.values()) - sum(r["size"] for r in now.values())) < 0.1 * sum(r["size"] for r in now.values())
        out.append(spark.createDataFrame(list(now.values()), df.schema))


def test_clean_text_of_several_languages_stays(spark):
    docs = read(spark, SF, "documents")
    of = {r.lang: r.text for r in docs.where("lang IS NOT NULL AND n_chars > 1000").collect()}
    assert len(of) >= 3
    parts = [of[k][:600] for k in sorted(of)]
    new = [(-1, " ".join(parts[:3]), None, "x", 0), (-2, " ".join(parts), None, "x", 0), (-3, "12 + 34 = 46", None, "x", 0), (-4, None, None, "x", 0)]
    df = docs.unionByName(spark.createDataFrame(new, "doc_id long, text string, lang string, source string, n_chars long"))
    found = {r["_row"].doc_id: r.score for r in lang_id.label(df.where("doc_id < 0"), lang_id.fit(docs, where=~lang_id.held_out())).collect()}
    assert 0 < found[-1] < 0.5 and 0 < found[-2] < 0.5  # every span is labelled, no language holds half
    assert {i for i in rows(p.language_stage(spark, df, SF)) if i < 0} == {-1, -2}


def test_empty_documents(spark):
    now = read(spark, SF, "documents").limit(0)
    for _, stage in p.STAGES:
        now = stage(spark, now, SF)
        assert now.count() == 0
    assert {"doc_id", "target", "taken"} <= set(now.columns)
