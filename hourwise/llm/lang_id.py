"""Operator 1, language ID: script ranges narrow a word's candidate languages, hashed character n-grams score the
word under each candidate, and Viterbi decoding with a switching penalty labels spans of mixed-language text.

Words are maximal runs of letters and marks.  A text's language is the one that labels most of its letters, its
score that share of the letters (0 to 1; ties go to the smaller language name).

Defined results: null text, or text without a letter -> no span, ``und``, score 0.  Nothing learned (no labelled
rows, empty table) -> ``und``, score 0 everywhere.  A label column of more than 1,000 values raises
``ValueError``: it is not a column of languages, and the model would have no bound.  Repeated rows are each labelled; a null id is kept; other
columns are never read.  Very long texts are scored in slices, so memory is bounded by one text and one slice.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, row_and

#: Unicode ranges (first, last code point) of the scripts told apart.  Letters elsewhere are "other".
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("ethiopic", 0x1200, 0x137F),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
)
SCRIPT_NAMES = sorted({s for s, _, _ in SCRIPTS}) + ["other"]

UNKNOWN = "und"
MAX_LANGS = 1000  # distinct labels; more than this is not a language column
TRIGRAMS, BIGRAMS = 1 << 16, 1 << 14
CHUNK_CHARS, SLICE_CHARS = 2_000_000, 500_000

_tables: dict[str, np.ndarray] = {}


def char_tables() -> dict[str, np.ndarray]:
    """Per code point: letter?, word character?, lower case, script (built once per worker)."""
    if not _tables:
        n = 0x110000
        kinds = [unicodedata.category(chr(c))[0] for c in range(n)]
        _tables["letter"] = np.fromiter((k == "L" for k in kinds), dtype=bool, count=n)
        _tables["word"] = np.fromiter((k in "LM" for k in kinds), dtype=bool, count=n)
        low = np.arange(n, dtype=np.uint32)
        for c in np.flatnonzero(_tables["letter"]):
            x = chr(c).lower()
            low[c] = ord(x) if len(x) == 1 else c
        _tables["lower"] = low
        script = np.full(n, SCRIPT_NAMES.index("other"), dtype=np.uint8)
        for name, a, b in SCRIPTS:
            script[a:b + 1] = SCRIPT_NAMES.index(name)
        _tables["script"] = script
    return _tables


@dataclass
class Words:
    """The words of some texts on one code point array: start, end, text number of each."""

    cp: np.ndarray
    folded: np.ndarray  # lower-cased word characters, 0 elsewhere
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    text_start: np.ndarray
    letters: np.ndarray  # letters of each word


def words_of(texts: list[str]) -> Words:
    t = char_tables()
    cp = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
    text_start = np.cumsum(sizes) - sizes
    mask = t["word"][cp]
    folded = np.where(mask, t["lower"][cp], 0).astype(np.uint32)
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    total = np.concatenate((np.zeros(1, np.int32), np.cumsum(t["letter"][cp], dtype=np.int32)))
    text = np.searchsorted(text_start, start, side="right") - 1
    return Words(cp, folded, start, end, text, text_start, total[end] - total[start])


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(12))


def grams(folded: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For positions a to b: trigram bucket, bigram bucket (offset by TRIGRAMS), and whether the position is in a
    word or right after one (the boundary counts as a character)."""
    pad = np.zeros(max(0, 2 - a), dtype=np.uint32)
    x = np.concatenate((pad, folded[max(0, a - 2):b]))
    c2, c1, c0 = x[:-2], x[1:-1], x[2:]
    c2 = np.where(c1 == 0, 0, c2).astype(np.uint32)
    bi = c1 * np.uint32(0x9E3779B1) + c0 * np.uint32(0x85EBCA77)
    tri = _finish(bi + c2 * np.uint32(0xC2B2AE3D)) & np.uint32(TRIGRAMS - 1)
    bi = (_finish(bi ^ np.uint32(0x27D4EB2F)) & np.uint32(BIGRAMS - 1)) + np.uint32(TRIGRAMS)
    return tri, bi, (c0 != 0) | (c1 != 0)


@dataclass
class Model:
    """Log probabilities of hashed n-grams per language and the scripts each language is written in."""

    langs: list[str] = field(default_factory=list)
    logp: np.ndarray | None = None  # (buckets, languages), float32
    scripts: np.ndarray | None = None  # (scripts, languages), bool


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, key: str = "doc_id",
        per_lang: int = 4000, min_script_share: float = 0.01) -> Model:
    """Learn from about ``per_lang`` labelled rows of each language (all of them, if fewer): rows are chosen by a
    hash of ``key`` against a rate from the language's row count, so the sample is bounded and repeatable.  Rows with
    a null label, null text or null key are not learned from.  The model has languages x 80k cells whatever the
    input's size, so it may go to every task."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    rows = rows.where(where) if where is not None else rows
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"{lang} has over {MAX_LANGS} values")
    if not counts:
        return Model()
    langs = sorted(counts)
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, per_lang / counts[k]))])
    u = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(u < rate[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    index = {k: i for i, k in enumerate(langs)}
    n_scripts = len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(langs), TRIGRAMS + BIGRAMS + n_scripts), dtype=np.int64)
        t = char_tables()
        for b in batches:
            texts = b.column("text").to_pylist()
            which = np.array([index[x] for x in b.column("lang").to_pylist()], dtype=np.int64)
            for part in chunks(map(len, texts), SLICE_CHARS):
                w = words_of(texts[part])
                tri, bi, ok = grams(w.folded, 0, len(w.folded))
                of = which[part][np.searchsorted(w.text_start, np.flatnonzero(ok), side="right") - 1]
                np.add.at(seen, (of, tri[ok]), 1)
                np.add.at(seen, (of, bi[ok]), 1)
                is_letter = np.flatnonzero(t["letter"][w.cp])
                of = which[part][np.searchsorted(w.text_start, is_letter, side="right") - 1]
                np.add.at(seen, (of, TRIGRAMS + BIGRAMS + t["script"][w.cp[is_letter]].astype(np.int64)), 1)
        i, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(bucket), pa.array(seen[i, bucket])], ["i", "bucket", "n"])

    cells = (sample.mapInArrow(count, "i long, bucket long, n long").groupBy("i", "bucket")
             .agg(F.sum("n").alias("n")).toArrow())
    seen = np.zeros((len(langs), TRIGRAMS + BIGRAMS + n_scripts))
    seen[cells["i"].to_numpy(), cells["bucket"].to_numpy()] = cells["n"].to_numpy()
    logp = np.empty((TRIGRAMS + BIGRAMS, len(langs)), dtype=np.float32)
    for a, b in ((0, TRIGRAMS), (TRIGRAMS, TRIGRAMS + BIGRAMS)):
        part = seen[:, a:b] + 0.1
        logp[a:b] = (0.5 * np.log(part / part.sum(axis=1, keepdims=True))).T
    by_script = seen[:, TRIGRAMS + BIGRAMS:]
    share = by_script / np.maximum(1, by_script.sum(axis=1, keepdims=True))
    return Model(langs, logp, (share >= min_script_share).T.copy())


def emissions(w: Words, model: Model, cap: float) -> np.ndarray:
    """(words, languages): log score of a word relative to its best candidate, not below -cap; languages that are
    not written in the word's script lie far below, unless no language is."""
    k = len(model.langs)
    out = np.zeros((len(w.start), k), dtype=np.float32)
    per_slice = max(20_000, SLICE_CHARS // max(1, k // 4))
    for part in chunks((w.end - w.start + 1).tolist(), per_slice):
        s, e = w.start[part], w.end[part]
        if not len(s):
            continue
        a, b = int(s[0]), int(e[-1]) + 1
        tri, bi, ok = grams(w.folded, a, b)
        score = model.logp[tri] + model.logp[bi]
        score[~ok] = 0
        out[part] = np.add.reduceat(score, s - a, axis=0)
    out = np.maximum(out - out.max(axis=1, keepdims=True), -cap) if len(out) else out
    candidate = model.scripts[char_tables()["script"][w.cp[w.start]]]
    candidate |= ~candidate.any(axis=1, keepdims=True)
    out[~candidate] -= 4 * cap
    return out


def viterbi(score: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of every word: texts are runs of ``count`` words from ``first``; a change of state between
    neighbouring words costs ``penalty``.  All texts advance together, one word a step."""
    n, k = score.shape
    state = np.zeros(n, dtype=np.int16)
    if not n:
        return state
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    active = np.searchsorted(-count, -np.arange(1, count[0] + 1), side="right")  # texts with at least t words
    back = np.zeros((n, k), dtype=np.int16 if k > 127 else np.int8)
    own = np.arange(k)
    d = score[first[:active[0]]].copy()
    for t in range(1, int(count[0])):
        m = active[t]
        d_t = d[:m]
        at = first[:m] + t
        best = d_t.argmax(axis=1)
        other = d_t[np.arange(m), best][:, None] - penalty
        switch = d_t < other
        back[at] = np.where(switch, best[:, None], own)
        d[:m] = np.where(switch, other, d_t) + score[at]
    now = d.argmax(axis=1)
    for t in range(int(count[0]) - 1, 0, -1):
        m = active[t]
        at = first[:m] + t
        state[at] = now[:m]
        now[:m] = back[at, now[:m]]
    state[first[:active[0]]] = now[:active[0]]
    return state


def label_texts(texts: list[str], model: Model, penalty: float, cap: float) -> list[tuple[list[tuple[int, int, str]], str, float]]:
    """For each text: spans (start, end, language) in code points, its language, its score."""
    out: list = [([], UNKNOWN, 0.0)] * len(texts)
    if not model.langs:
        return out
    for part in chunks(map(len, texts), CHUNK_CHARS):
        w = words_of(texts[part])
        if not len(w.start):
            continue
        n = part.stop - part.start
        count = np.bincount(w.text, minlength=n)
        first = np.cumsum(count) - count
        state = viterbi(emissions(w, model, cap), first, count, penalty)
        k = len(model.langs)
        by = np.bincount(w.text * k + state, weights=w.letters, minlength=n * k).reshape(n, k)
        new = np.concatenate(([True], (w.text[1:] != w.text[:-1]) | (state[1:] != state[:-1])))
        a = np.flatnonzero(new)
        b = np.concatenate((a[1:] - 1, [len(state) - 1]))
        of, base = w.text[a], w.text_start[w.text[a]]
        spans: dict[int, list] = {}
        for i, s, e, l in zip(of.tolist(), (w.start[a] - base).tolist(), (w.end[b] - base).tolist(), state[a].tolist()):
            spans.setdefault(i, []).append((s, e, model.langs[l]))
        total = by.sum(axis=1)
        best = by.argmax(axis=1)
        for i in np.flatnonzero(total):
            out[part.start + i] = (spans[i], model.langs[best[i]], float(by[i, best[i]] / total[i]))
    return out


def label(docs: DataFrame, model: Model, text: str = "text", penalty: float = 12.0, cap: float = 8.0) -> DataFrame:
    """``docs`` with columns ``lang_pred``, ``score`` and ``spans`` (code points, end exclusive) after its own in a
    struct ``_row``; one Arrow pass, no shuffle."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    schema = row_and(src, "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = label_texts([x or "" for x in b.column("_text").to_pylist()], sent.value, penalty, cap)
            spans = pa.array([[dict(zip(("start", "end", "lang"), s)) for s in f[0]] for f in found], type=span_type)
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()), spans],
                ["_row", "lang_pred", "score", "spans"])

    return src.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows whose crc32(key as text) leaves 1 modulo 3; false for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(3)) == 1, F.lit(False))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    model = fit(docs, where=~held_out())
    out = label(docs.select("doc_id", "text"), model)
    return out.select(F.col("_row.doc_id").alias("doc_id"), held_out("_row.doc_id").alias("held_out"), "lang_pred",
                      "score", F.size("spans").alias("n_spans"))
