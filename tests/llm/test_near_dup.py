import random

import numpy as np

from hourwise.llm import near_dup
from hourwise.llm.common import RollingHash, mixed

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((len(sets[i]), min(ids, default=None)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, "one\xa0two"), (None, "one two"), (None, "lone text of its own here")]
    for g in range(12):
        base = [word() for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(rng.choice([1, 3, 8])):
            copy = [word() if rng.random() < rng.choice([0, 0.01, 0.05]) else w for w in base]
            rows.append((1000 - len(rows), " ".join(copy)))
    chain = [word() for _ in range(200)]  # a chain of links whose ends are not alike
    for i in range(10):
        rows.append((2000 + i, " ".join(chain)))
        chain = chain[10:] + [word() for _ in range(10)]
    return rows + [rows[20], rows[0]]


def test_components_equal_brute_force(spark):
    for seed, words, percent in ((1, 3, 85), (2, 5, 80)):
        rows = corpus(seed)
        df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, label int")
        got = sorted(((r.id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(df, words=words, percent=percent).collect()), key=repr)
        want = []
        for (id_, _), (n, c) in zip(rows, brute(rows, words, percent)):
            c = c if n else id_
            want.append((id_, n, c, id_ == c))
        assert got == sorted(want, key=repr)


def test_one_of_each_group_stays(spark):
    rows = corpus(2)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _row string")
    got = near_dup.one_of_each(df)
    assert got.columns == df.columns
    groups = {}
    for (id_, t), (n, c) in zip(rows, brute(rows, 5, 80)):
        groups.setdefault(("empty", id_, t) if not n else ("group", c, t if c is None else ""), []).append((id_ is None, id_, t))
    kept = [(r.doc_id, r.text) for r in got.collect()]
    want = [x[1:] for k, own in groups.items() for x in (own if k[0] == "empty" else [min(own, key=repr)])]
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(w[0] for w in want if w[0] is not None) and len(kept) == len(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(df).count() == 0 and near_dup.one_of_each(df).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 400)]
    texts = [" ".join(words).encode(), " ".join(words[:360] + ["x"] * 1 + words[361:]).encode(), b"a b c d", b"one"]
    sets = near_dup.Sets(texts, 3)
    s = near_dup.sketches(sets, 192)
    assert (s != near_dup.EMPTY).all()  # every coordinate is filled, also for one element
    assert abs((s[0] == s[1]).mean() - 395 / 401) < 0.06
    assert sets.count.tolist() == [398, 398, 2, 1]


def test_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"xxabcabc", dtype=np.uint8)
    h = RollingHash(data)
    assert h(np.array([2]), np.array([5])) == h(np.array([5]), np.array([8])) and len(set(mixed(np.arange(1000, dtype=np.uint64)).tolist())) == 1000


def template_copies(n, seed=0, families=1):
    """Copies of one text with 15 words replaced and one phrase added everywhere; ``families`` copies of each differ in
    a few words more."""
    rng = np.random.default_rng(seed)
    rows = []
    for d in range(n):
        w = [f"t{i}" for i in range(300)]
        for i in rng.choice(300, 15, replace=False):
            w[i] = f"d{d}x{i}"
        at = int(rng.integers(300))
        w[at:at] = [f"p{i}" for i in range(12)]
        for f in range(families):
            v = list(w)
            for i in rng.choice(len(v), 3 * min(f, 1), replace=False):
                v[i] = f"d{d}f{f}x{i}"
            rows.append((len(rows), " ".join(v)))
    return rows


def test_unlinked_copies_of_a_template_are_not_compared_in_pairs(spark, monkeypatch):
    counts = []
    compare = near_dup._Search.compare

    def counted(self, pairs):
        counts.append(pairs.count())
        return compare(self, pairs)

    monkeypatch.setattr(near_dup._Search, "compare", counted)
    made = {}
    for n in (150, 300):
        counts.clear()
        df = spark.createDataFrame(template_copies(n), "doc_id long, text string")
        assert near_dup.near_duplicates(df, words=3, percent=85).where("kept").count() == n
        made[n] = list(counts)
    assert made[300][-1] <= 300 and sum(made[300]) < 4 * sum(made[150]) and sum(made[300]) < 300 * 299 / 4


def test_families_far_from_their_hub(spark):
    rows = template_copies(25, 3, families=4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((3, 85), (5, 80), (3, 60)):
        sets = [{tuple(t.split()[i:i + words]) for i in range(len(t.split()) - words + 1)} for _, t in rows]
        label = list(range(len(rows)))
        for i in range(len(rows)):
            for j in range(i):
                if label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                    a, b = sorted((label[i], label[j]))
                    label = [a if x == b else x for x in label]
        got = {r.id: r.component_id for r in near_dup.near_duplicates(df, words=words, percent=percent).collect()}
        assert [got[i] for i in range(len(rows))] == label


def test_a_pair_met_both_ways_is_compared_once(spark, monkeypatch):
    x = " ".join(f"w{i}" for i in range(100))
    texts = spark.createDataFrame([(bytes(15) + b"\1", x), (bytes(15) + b"\2", x + " end"), (bytes(15) + b"\3", "other words here")], "cls binary, text string")
    counts = []
    confirmed = near_dup.confirmed

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dup, "confirmed", counted)
    one, two, three = (bytearray(15) + bytes([i]) for i in (1, 2, 3))
    pairs = spark.createDataFrame([(one, two), (two, one), (two, one), (three, one)], "a binary, b binary")
    state = near_dup._Search(texts, 3, 85)
    state.compare(pairs)
    state.compare(pairs)
    assert counts == [2, 0]
    assert [(bytes(r.node), bytes(r.label)) for r in state.labels.collect()] == [(bytes(two), bytes(one))]


def test_few_tables_are_stored_and_shuffled(spark, monkeypatch):
    names = []
    stored = near_dup.stored

    def noted(df, name):
        names.append(name)
        return stored(df, name)

    monkeypatch.setattr(near_dup, "stored", noted)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:190 + i])) for i in range(5)] + [(9, "quite another text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in near_dup.near_duplicates(df, words=3, percent=85).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 9: 9}
    assert len(names) <= 7, names  # 11 before they were merged
