import random

import pytest

from hourwise.llm import mixing

DDL = "doc_id long, source string, text string, quality double, size string"  # size clashes with a result column


def water_filling(sizes):
    """Targets by repeated sharing of the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else w[s] * level for s in names}
        capped |= over


def test_targets_and_taken_words(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1200):
        source = rng.choice(["a", "b", "B", "é", None, "zz", *["hot"] * 6])
        n = rng.choice([0, 1, 3, 10, 40])
        rows.append((i, source, None if n == 0 and i % 2 else " ".join(["w"] * n) + "\t\n", rng.choice([None, 0.0, -1.0, float("nan"), 0.5, 4.0]), "x"))
    rows += [rows[5]] * 30 + [(None, "n", "x y z", 1.0, "x")] * 3 + [(9000, "zero", "  ", 1.0, "x")]
    df = spark.createDataFrame(rows, DDL).repartition(7)
    got = mixing.mix(df, quality="quality", buckets=16).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for r in got:
        assert r["size"] == len((r._row.text or "").split())
        sizes[r._row.source] = sizes.get(r._row.source, 0) + r["size"]
    aims = water_filling(sizes)
    taken: dict = {}
    for r in got:
        s = r._row.source
        assert r.source_size == sizes[s] and r.target == pytest.approx(aims[s], rel=1e-12)
        assert 0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - aims[s]) <= 20 for s in aims)
    again = mixing.mix(df.repartition(3), quality="quality", buckets=16).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_good_documents_are_chosen_more_often(spark):
    rows = [(i, "a" if i % 4 else "b", "w w w w", 8.0 if i % 2 else 0.5, "x") for i in range(2000)]
    got = [r for r in mixing.mix(spark.createDataFrame(rows, DDL), quality="quality").collect() if r._row.source == "a"]
    mean = lambda q: sum(r.taken for r in got if r._row.quality == q) / sum(1 for r in got if r._row.quality == q)
    assert mean(8.0) > mean(0.5)


def test_large_classes_at_the_cut_are_cut_again(spark):
    """All keys in the last class, a third of the rows without id, equal rows: the same choice as by a plain sort."""
    rng = random.Random(4)
    rows = [(i, "a", "w " * rng.choice([1, 2, 7]), rng.choice([1e-320, 1e-9, 0.001, 0.02]), str(i)) for i in range(600)]
    rows += [(None, "a", "w " * rng.choice([1, 3]) + str(i), 0.02, "x") for i in range(300)] + [(None, "a", "same text", 0.02, "x")] * 300
    rows += [(i, "b", "w " * 9, 1.0, "x") for i in range(2000, 2400)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], DDL + ", nth long")
    plain = mixing.mix(df, quality="quality", spread="nth", cut_rows=10**9).collect()
    finer = mixing.mix(df, quality="quality", spread="nth", cut_rows=5, buckets=8).collect()
    assert sorted((r._row.nth, r.taken) for r in plain) == sorted((r._row.nth, r.taken) for r in finer)
    assert len({r.taken / r["size"] for r in plain if r._row.source == "a"}) == 2


def test_the_class_left_to_be_ordered_is_small(spark):
    rows = spark.range(50_000).selectExpr("CASE WHEN id % 4 = 0 THEN 'a' ELSE 'b' END source", "id % 5 + 1 size",
                                          "-ln((id + 0.5) / 50000) / 0.001 e", "double(id % 7) tie", "double(id) spread")
    cuts = mixing._inside(rows, mixing.plan(rows, 3, 64, 20))
    assert 0 < max(r["count"] for r in cuts.where("cut").groupBy("source").count().collect()) <= 20


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DDL)).count() == 0
    only = mixing.mix(spark.createDataFrame([(1, None, None, None, None)], DDL)).first()
    assert (only["size"], only.source_size, only.target, only.taken) == (0, 0, 0.0, 0)


def test_no_python_in_the_plan(spark):
    from hourwise.llm.registry import QUERIES

    plan = QUERIES["op9_mix_sources"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.label_id: r.quality_weight for r in mixing.quality_weights(labels).collect()} == {1: 2.0, 2: 0.5, 3: None}
