"""Operator 12, toxicity by multiple-instance learning: only documents are labelled, sentences are judged.

A sentence s has the logit z = bias + the sum of the weights of its features (hashed character 4- to 7-grams of its
words, word ends included, and whole words; each once a sentence) and is offensive with probability 1 / (1 + exp(-z)).
Features only add evidence: weights are never negative, the bias speaks for innocence.
A document is toxic if any sentence is: noisy-or, 1 - prod(1 - p_s) = 1 - exp(-A) with A the sum of log(1 + exp(z)).
Weights are trained from document labels alone, by the gradient of the documents' likelihood through the noisy-or; the
trained sentence scores then locate the offending sentences.

Learning.  The labels are sampled first (at most about ``per_class`` rows of each class, by a hash of the id: the bound
of what is learned from), so the texts meet a small broadcast table and are never shuffled.  Document frequencies of
the hashed features by class choose those that speak for the label beyond chance (a G-test; at most ``features``, the
most telling first); the sample's sentences, reduced to these, are stored, and every gradient step is one Spark aggregate
over them: tasks send one sum per feature.  Rows are weighted by the inverse of their class's rate, so scores keep the
labels' base rate.

Defined results: a text without a word, empty or null, has one empty sentence.  Labels: null is no label, an id labelled
twice counts as toxic if any label says so, a null id is never learned from, repeated documents are each learned from.
Labels of one class only -> score 0 or 1 everywhere, as that class; no label at all -> 0; labels that no feature tells
apart -> the share of label 1.  Empty tables give no row.  Columns other than the named ones are not read and ride along
in ``_row``.  Slices hold whole texts, and a score does not depend on the slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, bounded_batches, chunks, mixed, powers, read, row_and, stored
from .lang_id import words_of

#: Code points that end a sentence (fixed values): line ends, . ! ? and their counterparts in other scripts.
ENDS = "\n\r  .!?。！？．؟۔।;።"
SLICE_CHARS = 250_000
CELLS = 1 << 22  # hashed features
GRAMS = (4, 5, 6, 7)
ODD = np.array([2 * (i + 1) * 0x4F1BBCDC + 1 & 0xFFFFFFFF for i in range(max(GRAMS))], dtype=np.uint32)

_ends: list[np.ndarray] = []


def _cells(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x7FEB352D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x846CA68B)
    return (h ^ (h >> np.uint32(16))) & np.uint32(CELLS - 1)


class Sentences:
    """The sentences (with a word) of some texts: text number, start and end in code points; and their features."""

    def __init__(self, texts: list[str]):
        w = words_of(texts)
        if not _ends:
            _ends.append(np.zeros(0x110000, dtype=bool))
            _ends[0][[ord(c) for c in ENDS]] = True
        before = np.cumsum(_ends[0][w.cp])[w.start]
        new = np.ones(len(w.start), dtype=bool)
        new[1:] = (before[1:] != before[:-1]) | (w.text[1:] != w.text[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(new)])) - 1 if len(first) else first
        self.text = w.text[first]
        self.start = w.start[first] - w.text_start[self.text]
        self.end = w.end[last] - w.text_start[self.text]
        self.count = np.bincount(self.text, minlength=len(texts))
        self.words, self.of_word = w, np.cumsum(new) - 1

    def features(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(sentence, feature) of every n-gram and word, with repeats; ``keep`` maps cells to features (-1: none)."""
        w = self.words
        end = np.zeros(max(GRAMS), w.folded.dtype)
        x = np.concatenate((end[:1], w.folded, end))  # a word's end before the first word, too
        sentence = np.full(len(x), -1, dtype=np.int64)  # of each word character
        sentence[x != 0] = np.repeat(self.of_word, w.end - w.start)
        owners, cells = [], []

        def add(owner: np.ndarray, cell: np.ndarray) -> None:
            if keep is not None:
                cell = keep[cell]
                on = np.flatnonzero(cell >= 0)
                owner, cell = owner[on], cell[on]
            owners.append(owner)
            cells.append(cell.astype(np.int64))

        # inner characters are a word's; the first and last may be its ends; a longer gram extends a shorter one
        at = np.flatnonzero((x[1:-max(GRAMS)] != 0) & (x[2:1 - max(GRAMS)] != 0))
        h = np.zeros(len(at), dtype=np.uint32)
        for j in range(GRAMS[0] - 1):
            h = (h + x[at + j]) * ODD[j]
        for n in GRAMS:
            if n > GRAMS[0]:
                on = np.flatnonzero(x[at + n - 2])
                at, h = at[on], h[on]
            h = (h + x[at + n - 1]) * ODD[n - 1]
            add(sentence[at + 1], _cells(h))
        if len(w.start):
            up, down = powers(len(x) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(x.astype(np.uint64)) * up[:len(x)])))
            whole = mixed((sums[w.end + 1] - sums[w.start + 1]) * down[w.start + 1] * np.uint64(BASE))
            add(self.of_word, _cells((whole >> np.uint64(32)).astype(np.uint32)))
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(owners), np.concatenate(cells)


def distinct(owner: np.ndarray, feature: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique(owner * size + feature)
    return code // size, code % size


@dataclass
class Model:
    """Cells of the chosen features, their weights and the bias; without features, a constant score."""

    cells: np.ndarray
    weights: np.ndarray
    bias: float
    constant: float | None = None

    def table(self) -> np.ndarray:
        t = np.full(CELLS, -1, dtype=np.int32)
        t[self.cells] = np.arange(len(self.cells))
        return t


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, where: Column | None, per_class: int) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """(text, y) of the sampled labelled documents; labelled ids of each class and the rate they are sampled at."""
    of = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
    of = of.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max((F.col(f"`{label}`") > 0).cast("int")).alias("y"))
    of = stored(of.where(where) if where is not None else of, "labels")
    counts = {r[0]: r[1] for r in of.groupBy("y").count().collect()}
    rates = {y: min(1.0, per_class / n) for y, n in counts.items()}
    u = F.pmod(F.xxhash64(F.col("_key").cast("string"), F.lit("toxicity sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = of.where(u < F.when(F.col("y") == 1, F.lit(rates.get(1, 0.0))).otherwise(F.lit(rates.get(0, 0.0))))
    # at most about 2 x per_class rows of two numbers
    rows = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), F.col("_id") == F.col("_key"))
    return rows.select("text", "y"), counts, rates


def chosen_features(rows: DataFrame, features: int, min_gain: float) -> DataFrame:
    """(cell, n1, n0, t1, t0): the cells more frequent in class 1 than in class 0 whose G-test (half of the statistic) gives
    ``min_gain`` or more, the most telling first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, CELLS), dtype=np.int32)
        n = [0, 0]
        for b in batches:
            texts, y = _texts(b.column("text")), b.column("y").to_numpy()
            for part in chunks(map(len, texts), SLICE_CHARS):
                s = Sentences(texts[part])
                owner, cell = s.features()
                doc, cell = distinct(s.text[owner], cell, CELLS)
                for c in (0, 1):
                    np.add.at(seen[c], cell[y[part][doc] == c], np.int32(1))
            for c in (0, 1):
                n[c] += int((y == c).sum())
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int64()), pa.array([*seen[1, at], n[1]], pa.int64()), pa.array([*seen[0, at], n[0]], pa.int64())],
                                         ["cell", "n1", "n0"])

    counts = stored(rows.mapInArrow(run, "cell long, n1 long, n0 long").groupBy("cell").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "feature-counts")
    total = counts.where("cell = -1").selectExpr("n1 AS t1", "n0 AS t0")
    of = counts.where(F.col("cell") >= 0).withColumn("_t", total.select(F.struct("t1", "t0")).scalar())
    of = of.select("cell", "n1", "n0", "_t.t1", "_t.t0").where(F.col("n1") * F.col("t0") > F.col("n0") * F.col("t1"))

    def part(seen: Column, share: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / share)).otherwise(0.0)

    n, t = F.col("n1") + F.col("n0"), F.col("t1") + F.col("t0")
    g = (part(F.col("n1"), n * F.col("t1") / t) + part(F.col("n0"), n * F.col("t0") / t)
         + part(F.col("t1") - F.col("n1"), (t - n) * F.col("t1") / t) + part(F.col("t0") - F.col("n0"), (t - n) * F.col("t0") / t))
    return of.withColumn("g", g).where(F.col("g") >= min_gain).orderBy(F.col("g").desc(), "cell").limit(features)


def reduced(rows: DataFrame, model: Model) -> DataFrame:
    """(y, empty, size, feature): of every sampled document, the sentences without a chosen feature, and the sizes and
    features of the others."""
    sent = rows.sparkSession.sparkContext.broadcast(model.table())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column("text"))
            empty, size, feature = [], [], []
            for part in chunks(map(len, texts), SLICE_CHARS):
                s = Sentences(texts[part])
                owner, f = distinct(*s.features(sent.value), CELLS)
                each = np.bincount(owner, minlength=len(s.text))
                n = part.stop - part.start
                used = np.bincount(s.text[each > 0], minlength=n)
                empty += np.maximum(s.count - used, np.where(s.count, 0, 1)).tolist()
                sizes, of = each[each > 0], s.text[owner]
                size += np.split(sizes, np.cumsum(used)[:-1])
                feature += np.split(f, np.cumsum(np.bincount(of, minlength=n))[:-1])
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(empty, pa.int64()), pa.array(size, pa.list_(pa.int64())), pa.array(feature, pa.list_(pa.int64()))],
                                             ["y", "empty", "size", "feature"])

    return rows.mapInArrow(run, "y int, empty long, size array<long>, feature array<long>")


def softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def gradient(batch, weights: np.ndarray, bias: float, cost: tuple[float, float]) -> np.ndarray:
    """Gradient of the weighted negative log likelihood of some ``reduced`` documents: weights, bias, and the loss."""
    y, empty = batch.column("y").to_numpy(), batch.column("empty").to_numpy()
    size, feature = batch.column("size"), batch.column("feature").flatten().to_numpy()
    of = np.repeat(np.arange(len(y)), np.diff(size.offsets.to_numpy()))  # document of each sentence
    sizes = size.flatten().to_numpy()
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    z = bias + np.bincount(sentence, weights=weights[feature], minlength=len(sizes))
    total = empty * softplus(np.array(bias)) + np.bincount(of, weights=softplus(z), minlength=len(y))
    total = np.maximum(total, 1e-12)
    per_doc = np.where(y == 1, -1 / np.expm1(np.minimum(total, 500.0)), 1.0) * np.where(y == 1, cost[1], cost[0])
    loss = (np.where(y == 1, -np.log(-np.expm1(-total)), total) * np.where(y == 1, cost[1], cost[0])).sum()
    dz = per_doc[of] / (1 + np.exp(-z))
    out = np.bincount(feature, weights=dz[sentence], minlength=len(weights))
    return np.concatenate((out, [dz.sum() + (per_doc * empty).sum() / (1 + np.exp(-bias)), loss]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        where: Column | None = None, per_class: int = 20_000, features: int = 1 << 14, min_gain: float = 10.0,
        steps: int = 30, rate: float = 0.3, l2: float = 1e-5) -> Model:
    """Learn from the labelled documents; ``where`` is a condition on ``_key``, the id.  See the module."""
    bounded_batches(docs.sparkSession)
    rows, counts, rates = sample(docs, labels, key, text, label, where, per_class)
    if len(counts) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, float(next(iter(counts), 0)))
    cells = chosen_features(rows, features, min_gain).toPandas()
    if not len(cells):  # nothing tells the classes apart
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, counts[1] / (counts[0] + counts[1]))
    n1, n0, t1, t0 = (cells[c].to_numpy(float) for c in ("n1", "n0", "t1", "t0"))
    start = 0.25 * np.clip(np.log((n1 + 0.5) / (t1 + 1)) - np.log((n0 + 0.5) / (t0 + 1)), -3, 3)
    model = Model(cells["cell"].to_numpy(np.int64), start, -6.0)
    kept = stored(reduced(rows, model), "sentences")
    cost = (1 / rates[0] / (t0[0] / rates[0] + t1[0] / rates[1]), 1 / rates[1] / (t0[0] / rates[0] + t1[0] / rates[1]))
    x = np.concatenate((model.weights, [model.bias]))
    m, v = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, steps + 1):  # Adam; each step is one aggregate over the sample
        def run(batches: Iterator[pa.RecordBatch], weights=x[:-1], bias=float(x[-1])) -> Iterator[pa.RecordBatch]:
            total = sum(gradient(b, weights, bias, cost) for b in batches)
            at = np.flatnonzero(total) if isinstance(total, np.ndarray) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at] if len(at) else np.zeros(0))], ["i", "g"])

        sums = kept.mapInArrow(run, "i long, g double").groupBy("i").agg(F.sum("g").alias("g")).toArrow()
        g = np.zeros(len(x) + 1)
        g[sums["i"].to_numpy()] = np.round(sums["g"].to_numpy(), 12)  # the order of the sums does not show
        g = g[:-1] + np.concatenate((l2 * x[:-1], [0.0]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        x[:-1] = np.maximum(x[:-1], 0)
    return Model(model.cells, x[:-1], float(x[-1]))


def score_texts(texts: list[str], model: Model, table: np.ndarray, located: float) -> list[tuple[float, int, list[tuple[int, int, float]]]]:
    """Of each text: score, sentences, and the sentences of at least ``located`` as (start, end, score)."""
    if model.constant is not None:
        return [(model.constant, 0, [])] * len(texts)
    out = []
    for part in chunks(map(len, texts), SLICE_CHARS):
        s = Sentences(texts[part])
        owner, f = distinct(*s.features(table), CELLS)
        z = model.bias + np.bincount(owner, weights=model.weights[f], minlength=len(s.text))
        n = part.stop - part.start
        total = np.bincount(s.text, weights=softplus(z), minlength=n) + np.where(s.count, 0, softplus(np.array(model.bias)))
        p = 1 / (1 + np.exp(-z))
        spans: dict[int, list] = {}
        for i in np.flatnonzero(p >= located).tolist():
            spans.setdefault(int(s.text[i]), []).append((int(s.start[i]), int(s.end[i]), float(p[i])))
        out += [(a, c, spans.get(i, [])) for i, (a, c) in enumerate(zip((-np.expm1(-total)).tolist(), s.count.tolist()))]
    return out


def scored(docs: DataFrame, model: Model, text: str = "text", located: float = 0.5) -> DataFrame:
    """``docs`` in a struct ``_row``, then ``score``, ``n_sentences`` and ``offending``: start, end (code points, end
    exclusive) and score of the sentences of at least ``located``.  One Arrow pass, no shuffle."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = row_and(src, "score double, n_sentences long, offending array<struct<start:int,end:int,score:double>>")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.table()
        for b in batches:
            found = score_texts(_texts(b.column("_text")), sent.value, table, located)
            spans = pa.array([[dict(zip(("start", "end", "score"), s)) for s in f[2]] for f in found], type=kind)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64()), spans],
                                             ["_row", "score", "n_sentences", "offending"])

    return src.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Rows whose crc32(key as text) leaves 0 modulo 5; false for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(False))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels"), where=~held_out(F.col("_key")))
    out = scored(docs, model)
    return out.select("_row.doc_id", held_out(F.col("_row.doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", F.size("offending").cast("long").alias("n_offending"))
