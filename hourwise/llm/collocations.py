"""Operator 11, phrase collocations by direct-address tiling.

A text, A-Z lower-cased, is cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs.
Everything is counted per language: all word occurrences (n), and the contiguous occurrences f of phrases inside pieces.
Candidates are phrases of 2 to ``longest`` words with a = f >= ``min_count``; so every part of one is as frequent.

Counting goes by levels.  Frequent words (of all languages together) are ranked by frequency and numbered; a pair of
neighbours is a cell (number, number) of a square cut into tiles.  A task collects cells and empties its buffer when it
is full: tiles that hold many of them are counted by ``numpy.bincount`` with one counter per cell (low ranks meet in few
tiles, which hold most pairs), the other cells are sorted and counted as coordinates; Spark sums the counts of all
tasks.  The frequent pairs are ranked and numbered anew and meet the words behind them in the same way, and so on: the
cells of level m are (phrase of m words, next word), counted only where both phrases of m words in it are frequent.

Numbers are sent to all tasks, so there are at most ``ranked`` of them a level: the phrases above a frequency found
from a histogram.  Frequent phrases beyond that are not lost: their hashes set the bits of a table of fixed size, and a
phrase all of whose parts are numbered or marked there goes to Spark as text and is counted exactly; marks set by
chance only add rows that the threshold removes.

The score of a cut is floor(1000000 a a / (l r)) in whole numbers of 38 digits; the lowest counts, ties to the smallest
first part.  A candidate goes if its words stand inside a longer candidate b with 100 f(b) >= ``inside`` a.

Defined results: null text has no word; a null language is ``und`` and joins documents so labelled.  Repeated rows count
each.  A word may be of any length; texts are counted whole.  An empty table, or one without a frequent phrase, gives
no row.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import sorted_index
from .common import BASE, LOWER, RollingHash, bounded_batches, chunks, mixed, read, runs, stored

SLICE_BYTES = 2 << 20
TILE = 1 << 11  # numbers a side
BUFFER = 2 << 20  # cells a task collects before it counts them
RANKED = (1 << 18, 1 << 20)  # numbers of words, and of phrases of a level
MARKS = 1 << 24  # bits of the table of frequent phrases without a number
SHIFT = 32

GAP = np.zeros(256, dtype=np.uint8)  # 1: between words, 2: between pieces
GAP[[0x20, 0x09]] = 1
GAP[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


class Words:
    """The words of some texts: an Arrow array of them, and whether each stands right behind the one before it."""

    def __init__(self, texts: list[bytes]):
        data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
        gap = GAP[data]
        start, end = runs(gap == 0)
        piece = np.cumsum(gap == 2)[start] if len(start) else start
        self.follows = np.zeros(len(start), dtype=bool)
        self.follows[1:] = piece[1:] == piece[:-1]
        offsets = np.concatenate(([0], np.cumsum(end - start)))
        self.text = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[gap == 0]))
        self.of = data, start, end

    @cached_property
    def hash(self) -> np.ndarray:
        data, start, end = self.of
        return mixed(RollingHash(data)(start, end)) if len(start) else np.zeros(0, np.uint64)


def phrase_hash(hashes: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(hashes[0]), dtype=np.uint64)
    for x in hashes:
        h = h * np.uint64(BASE) + x
    return mixed(h + np.uint64(len(hashes)))


@dataclass
class Level:
    """The frequent phrases of one length: what has a number, in order of the numbers, and the marks of the rest."""

    words: dict[str, pa.Array] = field(default_factory=dict)  # level 1: words of each language
    numbers: dict[str, np.ndarray] = field(default_factory=dict)
    cells: np.ndarray | None = None  # level 2 and above: cell of each number
    marks: np.ndarray | None = None  # bits; None: every frequent phrase has a number

    def marked(self, h: np.ndarray) -> np.ndarray:
        bit = (h % np.uint64(MARKS)).astype(np.int64)
        return (self.marks[bit >> 3] >> (bit & 7)) & 1 == 1


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    """Slices of the texts of one language."""
    lang = batch.column("lang")
    for k in pc.unique(lang).to_pylist():
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").filter(pc.equal(lang, k)).to_pylist()]
        for part in chunks(map(len, texts), SLICE_BYTES):
            yield k, Words(texts[part])


def rows_of(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.where(F.col(f"`{text}`").isNotNull()).select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(rows: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of the words of at least ``min_count`` occurrences, and (lang, n) of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, w in _by_language(b):
                seen = pc.value_counts(w.text)
                word = seen.field("values").cast(pa.string())
                n = seen.field("counts")
                # the row without a word is the language's total
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * (len(word) + 1)), pa.concat_arrays([word, pa.array([None], pa.string())]),
                     pa.concat_arrays([n, pa.array([len(w.text)], pa.int64())])], ["lang", "phrase", "f"])

    counts = rows.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counts = stored(counts.where((F.col("f") >= min_count) | F.col("phrase").isNull()), "words")
    return counts.where("phrase IS NOT NULL"), counts.where("phrase IS NULL").select("lang", F.col("f").alias("n"))


def frequency_class(f: Column) -> Column:
    return F.floor(F.log2(f) * 64).cast("int")


def numbered(phrases: DataFrame, most: int) -> tuple[DataFrame, int | None]:
    """The most frequent phrases, at most ``most`` of them and whole classes of like frequency, and the least class
    taken (None: all).  There are 64 classes for each doubling of the frequency."""
    classes = sorted(((r[0], r[1]) for r in phrases.groupBy(frequency_class(F.col("f")).alias("c")).count().collect()), reverse=True)
    total, least = 0, None
    for c, n in classes:
        if total + n > most:
            return phrases.where(frequency_class(F.col("f")) > c), c
        total += n
    return phrases, None


def marks_of(phrases: DataFrame) -> np.ndarray:
    """The bit table of some phrases (lang is not told apart: a foreign mark only adds rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            split = [p.encode().split(b" ") for p in b.column("phrase").to_pylist()]
            if split:
                flat = [w for p in split for w in p]
                data = np.frombuffer(b" ".join(flat) + b" ", dtype=np.uint8)
                size = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
                start = np.cumsum(size + 1) - size - 1
                h = mixed(RollingHash(data)(start, start + size)).reshape(len(split), -1)
                bit = phrase_hash(list(h.T)) % np.uint64(MARKS)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(bit).astype(np.int64))], ["bit"])

    bits = phrases.mapInArrow(run, "bit long").distinct().toArrow()["bit"].to_numpy()
    out = np.zeros(MARKS >> 3, dtype=np.uint8)
    np.bitwise_or.at(out, bits >> 3, (1 << (bits & 7)).astype(np.uint8))
    return out


def word_level(words: DataFrame, most: int) -> tuple[Level, DataFrame]:
    """Numbers of the words by falling frequency, and the table (id, lang, phrase, f) of them."""
    top, least = numbered(words, most)
    table = stored(sorted_index(top, [F.col("f").desc(), "lang", "phrase"], index_col="id"), "numbers")
    rows = table.select("id", "lang", "phrase").toArrow()  # at most ``most`` words
    ids, lang, word = rows["id"].to_numpy(), rows["lang"].combine_chunks(), rows["phrase"].combine_chunks().cast(pa.large_string())
    level = Level()
    for k in pc.unique(lang).to_pylist():
        own = pc.equal(lang, k)
        level.words[k], level.numbers[k] = word.filter(own), ids[own.to_numpy(zero_copy_only=False)]
    if least is not None:
        level.marks = marks_of(words.where(frequency_class(F.col("f")) <= least))
    return level, table


def phrase_level(phrases: DataFrame, most: int) -> tuple[Level, DataFrame]:
    """The same for longer phrases (lang, phrase, f, cell): what has a cell may have a number, the rest is marked."""
    with_cell = phrases.where("cell IS NOT NULL")
    top, least = numbered(with_cell, most)
    table = stored(sorted_index(top, [F.col("f").desc(), "cell"], index_col="id"), "numbers")
    rows = table.select("id", "cell").toArrow()  # at most ``most`` pairs of integers
    level = Level(cells=rows["cell"].to_numpy()[np.argsort(rows["id"].to_numpy())])
    rest = phrases.where(F.col("cell").isNull() | (frequency_class(F.col("f")) <= least) if least is not None else F.col("cell").isNull())
    if not rest.isEmpty():
        level.marks = marks_of(rest.select("phrase"))
    return level, table


class Tiles:
    """Counts of the cells (a, b) that a task meets."""

    def __init__(self, tile: int = TILE, buffer: int = BUFFER):
        self.tile, self.buffer, self.parts, self.held = tile, buffer, [], 0

    def add(self, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(cells):
            self.parts.append(cells)
            self.held += len(cells)
        if self.held >= self.buffer:
            yield from self.counts()

    def counts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(cells, counts) of all that is held: tiles that are dense enough by direct address, the rest sorted."""
        cells = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        self.parts, self.held = [], 0
        a, b = cells >> SHIFT, cells & ((1 << SHIFT) - 1)
        row, col = a // self.tile, b // self.tile
        side = int(col.max()) + 1 if len(col) else 1
        tile = row * side + col
        order = np.argsort(tile, kind="stable")
        sorted_tiles = tile[order]
        first = np.flatnonzero(np.concatenate(([True], sorted_tiles[1:] != sorted_tiles[:-1]))) if len(tile) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(tile)))
        dense = size >= self.tile * self.tile // 16
        for f, n in zip(first[dense].tolist(), size[dense].tolist()):
            own = order[f:f + n]
            top, left = int(row[own[0]]) * self.tile, int(col[own[0]]) * self.tile
            seen = np.bincount((a[own] - top) * self.tile + b[own] - left, minlength=self.tile * self.tile)
            at = np.flatnonzero(seen)
            yield ((top + at // self.tile) << SHIFT) + left + at % self.tile, seen[at]
        rest = np.sort(cells[order[~np.repeat(dense, size)]])
        if len(rest):
            at = np.flatnonzero(np.concatenate(([True], rest[1:] != rest[:-1])))
            yield rest[at], np.diff(np.append(at, len(rest)))


def pair_counts(rows: DataFrame, levels: list[Level], length: int, min_count: int) -> DataFrame:
    """(cell, lang, phrase, f): the frequent phrases of ``length`` words, as cells (number of the first length - 1 words,
    number of the last word) or, where those have no numbers, as text in a language."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[Level] = sent.value
        tiles = Tiles()

        def counted(made) -> Iterator[pa.RecordBatch]:
            for cells, n in made:
                none = pa.nulls(len(cells), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(cells), none, none, pa.array(n, pa.int64())], ["cell", "lang", "phrase", "f"])

        for batch in batches:
            for lang, w in _by_language(batch):
                number = _numbers(levels[0].words.get(lang), levels[0].numbers.get(lang), w.text)
                known = number >= 0
                if levels[0].marks is not None:
                    known |= levels[0].marked(phrase_hash([w.hash]))
                word = number
                for m in range(2, length + 1):  # phrases by their last word; both their parts of m - 1 words are known
                    at = np.flatnonzero(known[:-1] & known[1:] & w.follows[1:]) + 1
                    cell = np.where((number[at - 1] >= 0) & (word[at] >= 0), (number[at - 1] << SHIFT) + word[at], -1)
                    if m == length:
                        yield from counted(tiles.add(cell[cell >= 0]))
                        other = at[cell < 0]
                        if len(other):
                            text = w.text.take(pa.array(other - m + 1))
                            for j in range(m - 2, -1, -1):
                                text = pc.binary_join_element_wise(text, w.text.take(pa.array(other - j)), pa.scalar(" ", pa.large_string()))
                            seen = pc.value_counts(text)
                            yield pa.RecordBatch.from_arrays(
                                [pa.nulls(len(seen), pa.int64()), pa.array([lang] * len(seen)), seen.field("values").cast(pa.string()), seen.field("counts")],
                                ["cell", "lang", "phrase", "f"])
                        break
                    level = levels[m - 1]
                    found = pc.index_in(pa.array(cell), pa.array(level.cells)).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                    number = np.full(len(known), -1, dtype=np.int64)
                    number[at] = np.where(cell >= 0, found, -1)
                    known = number >= 0
                    if level.marks is not None:
                        known[at] |= level.marked(phrase_hash([w.hash[at - j] for j in range(m - 1, -1, -1)]))
        yield from counted(tiles.counts())

    counts = rows.mapInArrow(run, "cell long, lang string, phrase string, f long")
    counts = counts.groupBy("cell", "lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    return stored(counts, f"cells-{length}")


def _numbers(words: pa.Array | None, numbers: np.ndarray | None, text: pa.Array) -> np.ndarray:
    """Number of each word, -1 for those without."""
    if words is None or not len(words):
        return np.full(len(text), -1, dtype=np.int64)
    at = pc.index_in(text, words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(at >= 0, numbers[at], -1)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10,
                     ranked: tuple[int, int] = RANKED) -> tuple[DataFrame, DataFrame]:
    """(lang, m, phrase, f) of all phrases of 1 to ``longest`` words and at least ``min_count`` occurrences, and the
    languages' (lang, n)."""
    bounded_batches(docs.sparkSession)
    rows = rows_of(docs, text, lang)
    words, totals = word_counts(rows, min_count)
    level, word_table = word_level(words, ranked[0])
    levels, ids, known = [level], word_table.select("id", "lang", "phrase"), words.withColumn("m", F.lit(1))
    for m in range(2, longest + 1):
        found = pair_counts(rows, levels, m, min_count)
        # cells become text again: first the phrase's own table, then the word's
        first = ids.select(F.col("id").alias("_a"), F.col("lang").alias("_lang"), F.col("phrase").alias("_first"))
        last = word_table.select(F.col("id").alias("_b"), F.col("phrase").alias("_last"))
        cells = found.where("cell IS NOT NULL").select("cell", "f", F.shiftright("cell", SHIFT).alias("a"), F.col("cell").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b"))
        cells = cells.join(first, F.col("a") == F.col("_a")).join(last, F.col("b") == F.col("_b"))
        phrases = cells.select(F.col("_lang").alias("lang"), F.concat_ws(" ", "_first", "_last").alias("phrase"), "f", "cell")
        texts = found.where("cell IS NULL").select("lang", "phrase", "f", "cell")
        phrases = stored(phrases.unionByName(texts), f"phrases-{m}")
        known = known.unionByName(phrases.select("lang", "phrase", "f", F.lit(m).alias("m")))
        if m < longest:
            level, ids = phrase_level(phrases, ranked[1])
            levels.append(level)
    return known, totals


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers (decimals of 38 digits: a, l, r below 10^15)."""
    a, l, r = (x.cast("decimal(15,0)") for x in (a, l, r))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * a * a, l * r).cast("long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, min_count: int = 10,
                 inside: int = 50, ranked: tuple[int, int] = RANKED) -> DataFrame:
    """(lang, phrase, m, a, l, r, n, score) of every candidate that no longer candidate replaces."""
    known, totals = frequent_phrases(docs, text, lang, longest, min_count, ranked)
    known = stored(known, "phrases")
    of = known.where("m > 1").withColumn("w", F.split("phrase", " "))

    def joined(start: Column | int, size: Column | int) -> Column:
        return F.array_join(F.slice("w", start, size), " ")

    cuts = of.select("lang", "phrase", "m", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "m", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    part = known.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("_f"))
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(name) == F.col("_phrase"))).withColumn(count, F.col("_f")).drop("_lang", "_phrase", "_f")
    best = cuts.groupBy("lang", "phrase").agg(F.first("m").alias("m"), F.first("a").alias("a"), F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))
    # the most frequent longer candidate around each phrase
    parts = of.where("m > 2").select("lang", "f", "w", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size"))
    parts = parts.select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1)).alias("at"))
    around = parts.select("lang", joined(F.col("at"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    around = around.withColumnsRenamed({"lang": "_lang", "phrase": "_phrase"})
    left = best.join(around, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
    left = left.where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
    totals = totals.withColumnRenamed("lang", "_l")
    return left.join(totals, F.col("lang") == F.col("_l")).select("lang", "phrase", "m", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def top(found: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` of each language with their ``rank``."""
    w = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).withColumn("rank", F.col("rank").cast("long"))


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("text", "lang")
    return top(collocations(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
runs AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 4) AS t(m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM runs GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
key AS MATERIALIZED (SELECT lang || chr(9) || phrase AS key, f FROM f WHERE f >= 10),
cand AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
parts AS MATERIALIZED (SELECT lang, phrase, a, k, lang || chr(9) || array_to_string(w[1:k], ' ') AS first, lang || chr(9) || array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
cut AS (SELECT lang, phrase, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM parts JOIN key x ON x.key = first JOIN key y ON y.key = rest),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS b FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
  FROM cand WHERE m = 3) GROUP BY ALL),
dropped AS (SELECT lang, phrase FROM cand JOIN longer USING (lang, phrase) WHERE m = 2 AND 100 * b >= 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best ANTI JOIN dropped USING (lang, phrase) JOIN n USING (lang)
QUALIFY rank <= 2000
"""
