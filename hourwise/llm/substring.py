"""Operator 6, suffix-array dedup: repeated strings by minimizer anchors and grouped hashes.

Every byte covered by a ``length``-byte string that also starts anywhere else is removed.  Prefix doubling would name
the strings of growing lengths by pairs (rank of the first part, rank of the part at the offset).  Ranking all byte
positions in every round would shuffle the input many times over, so these are not its rounds: nothing is sorted or
ranked again at growing offsets.  Three groupings by hashes take their place, with the same result:

1. *Anchors.*  The window of ``length`` bytes at a start p is tied to one position a in [p, p + length - core], the one
   with the least hash of the 32 bytes there (leftmost of equals).  It depends on the window's bytes alone, so equal
   windows have equal anchors at equal distance, and all starts tied to one anchor form a run, its *slot*.  Anchors
   are grouped by the name of the pair of halves of the ``core`` bytes at the anchor, which every
   window of the slot holds.  If that is unique, no window of the slot is repeated: the slot drops out.
2. *Slots.*  Slots left are ranked by name of all their bytes: equal slots (two or more) are repeated at every start.
3. *Positions.*  Where a core is shared by slots that differ, and some of them occur once, the starts of one slot of
   each kind go through the last round byte by byte: pairs of the names of the two halves of the window, the second
   at the doubled offset.  A pair that occurs twice is a repeated window.

Names are 64-bit hashes of the bytes; equal strings always get equal names, and Spark needs no global dense ranks.
What decides on removal has 128 bits: a core's name with the slot's, or the pair of the last round.  Repeated starts are merged to byte ranges per text and cut out.  Texts are named by two hashes;
exact copies of a text meet in the same ranges.

*Passages shared by documents.*  A passage of over 50 words may be shorter than ``length`` bytes and then stays, but
``n_shared_words`` counts the document's words in runs of ``words`` words that another document holds too (another row;
a repeat inside one document does not count).  Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte.  The rounds are
the same with words in place of bytes: anchors in word windows, slots equal in two documents settled whole, starts of
slots that differ one by one (in the last round, with the byte slots).  A text with copies is shared whole.

Defined results: null text is empty; texts shorter than ``length`` are kept whole; repeated rows are copies like any
others; ids may be null; other columns are not read.  Matches never cross documents; overlapping matches count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, RollingHash, bounded_batches, chunks, mixed, powers, read, release, row_and, runs, stored

LENGTH, CORE, GRAM = 400, 300, 32
WORDS, WORD_CORE, WORD_GRAM = 51, 20, 4
SEGMENT = 4 << 20  # bytes of a text looked at at once
CHUNK = 2 << 20  # bytes of short texts whose words are looked at at once
WORD_SEGMENT = 1 << 19  # words of a long text looked at at once
TIE = np.uint64((1 << 24) - 1)
LENS = np.uint64(0x9FB21C651E98DF25)


class WordHash(RollingHash):
    """Hashes of any ranges of words, from prefix sums over the hashes of the words."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        values = mixed(RollingHash(data)(starts, ends)) | np.uint64(1)
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words."""
    return runs((data != 32) & ((data < 9) | (data > 13)))


def slots(n: int, h: RollingHash, length: int, core: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of every slot of one text of n bytes (or words), in order."""
    anchor = anchor_of_starts(n, h, length, core, gram)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    return anchor[first], first, np.append(first[1:], len(anchor)) - 1


def anchor_of_starts(n: int, h: RollingHash, length: int, core: int, gram: int) -> np.ndarray:
    width = length - core + 1
    at = np.arange(n - core + 1)
    rank = mixed(h(at, at + gram)) & ~TIE | at.astype(np.uint64)
    step = 1
    while 2 * step <= width:
        rank = np.minimum(rank[:-step], rank[step:])
        step *= 2
    if step < width:
        rank = np.minimum(rank[:step - width], rank[width - step:])
    return (rank & TIE).astype(np.int64)


def names(h: RollingHash, a: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the core and of the whole slot."""
    half = core // 2
    slot = mixed(h(lo, hi + length) ^ mixed(((a - lo) << 32 | (hi - lo)).astype(np.uint64) * LENS))
    return mixed(mixed(h(a, a + half)) * np.uint64(BASE) + h(a + half, a + core)), slot


def segments(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a long text, each with the windows of SEGMENT starts; a slot cut by a border is two slots."""
    for a in range(0, max(1, len(data) - length + 1), SEGMENT):
        yield a, data[a:a + SEGMENT + length - 1]


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)


def anchors(docs: DataFrame, length: int, core: int) -> DataFrame:
    """(core, slot, k1, k2, start, width): one row for each slot of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            rows = 0
            for text, k1, k2 in zip(b.column("text"), b.column("k1").to_pylist(), b.column("k2").to_pylist()):
                whole = _bytes(text.as_py())
                if len(whole) < length:
                    continue
                for base, data in segments(whole, length):
                    h = RollingHash(data)
                    a, lo, hi = slots(len(data), h, length, core)
                    pair, name = names(h, a, lo, hi, length, core)
                    out.append((pair, name, k1, k2, lo + base, hi - lo + 1))
                    rows += len(a)
                if rows > 200_000:
                    yield _slot_batch(out)
                    out, rows = [], 0
            if out:
                yield _slot_batch(out)

    return docs.mapInArrow(run, "core long, slot long, k1 long, k2 int, start long, width int")


def _slot_batch(out: list[tuple]) -> pa.RecordBatch:
    n = [len(o[0]) for o in out]
    join = lambda i: np.concatenate([o[i] for o in out])
    key = lambda i, kind: pa.array(np.repeat(np.array([o[i] for o in out], dtype=kind), n))
    return pa.RecordBatch.from_arrays(
        [pa.array(join(0).view(np.int64)), pa.array(join(1).view(np.int64)), key(2, np.int64), key(3, np.int32), pa.array(join(4)), pa.array(join(5).astype(np.int32))],
        ["core", "slot", "k1", "k2", "start", "width"])


def word_slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, words: int, core: int) -> tuple[np.ndarray, ...]:
    """(core, slot, first start, width) of every slot of words; ``text`` numbers the text of every word, no window crosses texts."""
    h = WordHash(data, starts, ends)
    anchor = anchor_of_starts(len(starts), h, words, core, min(core, WORD_GRAM))
    anchor[text[:len(anchor)] != text[words - 1:]] = -1
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.append(first[1:], len(anchor)) - 1
    lo, hi = first[anchor[first] >= 0], last[anchor[first] >= 0]
    return *names(h, anchor[lo], lo, hi, words, core), lo, hi - lo + 1


def word_anchors(docs: DataFrame, words: int, core: int) -> DataFrame:
    """(core, slot, k1, k2, start, width): one row for each slot of the words of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").encode("utf-8", "replace") for t in b.column("text").to_pylist()]
            keys = [b.column(k).to_numpy() for k in ("k1", "k2")]
            for part in chunks(map(len, texts), CHUNK):
                sizes = np.array([len(t) + 1 for t in texts[part]])
                data = np.frombuffer(b" ".join(texts[part]) + b" ", dtype=np.uint8)
                starts, ends = word_spans(data)
                text = np.repeat(np.arange(len(sizes)), np.diff(np.searchsorted(starts, np.append(0, np.cumsum(sizes)))))
                head = np.searchsorted(text, np.arange(len(sizes)))
                for w in range(0, max(0, len(starts) - words + 1), WORD_SEGMENT):
                    s, e = starts[w:w + WORD_SEGMENT + words - 1], ends[w:w + WORD_SEGMENT + words - 1]
                    name, slot, lo, width = word_slots(data[s[0]:e[-1]], s - s[0], e - s[0], text[w:w + len(s)], words, core)
                    of = text[lo + w]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name.view(np.int64)), pa.array(slot.view(np.int64)), *(pa.array(k[part][of]) for k in keys),
                         pa.array(lo + w - head[of]), pa.array(width.astype(np.int32))], ["core", "slot", "k1", "k2", "start", "width"])

    return docs.mapInArrow(run, "core long, slot long, k1 long, k2 int, start long, width int")


def repeated_cores(found: DataFrame) -> DataFrame:
    """The slots whose core occurs more than once.  Copies of a text repeat its slots: they are counted, one row stays.
    One shuffle by core serves both steps."""
    found = found.withColumn("n", F.count("*").over(Window.partitionBy("core"))).where("n > 1")
    return found.groupBy("core", "slot", "k1", "k2", "start", "width").agg(F.count("*").alias("copies"))


def shared_word_slots(docs: DataFrame, words: int, core: int) -> DataFrame:
    """(k1, k2, start, width, shared, kind): slots of words that another document holds whole (``shared``), and those to
    be asked for start by start: not shared, though their core is in several texts (kind 1), or a shared one of the same
    core (kind 2, one place for each)."""
    found = repeated_cores(word_anchors(docs, words, core))
    of_core, of_slot, place = Window.partitionBy("core"), Window.partitionBy("core", "slot"), F.struct("k1", "k2", "start")
    found = found.withColumns({
        "shared": (F.min("k1").over(of_slot) < F.max("k1").over(of_slot)) | (F.max("copies").over(of_slot) > 1),
        "first": place == F.min(place).over(of_slot)})
    found = found.withColumns({
        "open": (F.min("k1").over(of_core) < F.max("k1").over(of_core)) & ~F.min("shared").over(of_core)})
    kind = F.when(F.col("open") & ~F.col("shared"), 1).when(F.col("open") & F.col("first"), 2)
    return found.select("k1", "k2", "start", "width", "shared", kind.alias("kind")).where("shared OR kind IS NOT NULL")


def _starts(own: pa.StructScalar, kind: int) -> np.ndarray:
    """The starts of the slots of one kind."""
    of = own.field("kind").to_numpy(zero_copy_only=False) == kind
    start = own.field("start").to_numpy(zero_copy_only=False)[of]
    width = own.field("width").to_numpy(zero_copy_only=False)[of]
    p = np.repeat(start, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    return np.unique(p)


def window_pairs(texts: DataFrame, length: int, words: int) -> DataFrame:
    """(kind, n1, n2, k1, k2, p): the pair of names of every start of the slots listed in ``slots`` of each text; of bytes
    (kind 0) or of words (kind 1; p is -1 where the slot was of kind 2, shared whole)."""

    def batch(kind: int, h: RollingHash, q: np.ndarray, size: int, k1: int, k2: int, p: np.ndarray) -> pa.RecordBatch:
        half = size // 2
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(q), kind, np.int32)), pa.array(mixed(h(q, q + half)).view(np.int64)), pa.array(mixed(h(q + half, q + size)).view(np.int64)),
             pa.array(np.full(len(q), k1)), pa.array(np.full(len(q), k2, np.int32)), pa.array(p)], ["kind", "n1", "n2", "k1", "k2", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, k1, k2, own in zip(b.column("text"), b.column("k1").to_pylist(), b.column("k2").to_pylist(), b.column("slots")):
                whole = _bytes(text.as_py())
                p, open_, marks = (_starts(own.values, kind) for kind in range(3))
                for base, data in segments(whole, length) if len(p) else ():
                    q = p[(p >= base) & (p < base + SEGMENT)] - base
                    if len(q):
                        yield batch(0, RollingHash(data), q, length, k1, k2, q + base)
                if not len(open_) + len(marks):
                    continue
                starts, ends = word_spans(whole)
                for w in range(0, len(starts) - words + 1, WORD_SEGMENT):
                    s, e = starts[w:w + WORD_SEGMENT + words - 1], ends[w:w + WORD_SEGMENT + words - 1]
                    inside = [r[(r >= w) & (r < w + WORD_SEGMENT)] - w for r in (open_, marks)]
                    q = np.concatenate(inside)
                    if len(q):
                        at = np.concatenate((inside[0] + w, np.full(len(inside[1]), -1)))
                        yield batch(1, WordHash(whole[s[0]:e[-1]], s - s[0], e - s[0]), q, words, k1, k2, at)

    return texts.mapInArrow(run, "kind int, n1 long, n2 long, k1 long, k2 int, p long")


def covered(ranges: Column, length: int) -> Column:
    """How many items the windows at the starts of ``ranges``, array of (first, last start), cover."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(done: Column, r: Column) -> Column:
        end = F.greatest(r["z"] + length, done["end"])
        return F.struct(end.alias("end"), (done["n"] + end - F.greatest(r["a"], done["end"])).alias("n"))

    return F.aggregate(F.array_sort(ranges), start, add, lambda done: done["n"])


def repeated_starts(docs: DataFrame, text: str = "text", length: int = LENGTH, core: int = CORE, words: int = WORDS, word_core: int = WORD_CORE) -> DataFrame:
    """(k1, k2, ranges, n_shared_words): for every text with repeated windows, array of (first, last start), unmerged, and
    the number of words in windows of ``words`` words that another document holds."""
    spark = docs.sparkSession
    bounded_batches(spark)
    t = F.col(f"`{text}`")
    texts = docs.where(F.octet_length(t) >= min(length, 2 * words - 1)).select(*text_key(t), t.alias("text"))
    word_left = stored(shared_word_slots(texts, words, word_core), "word-slots")
    release(spark)

    src = texts.where(F.octet_length("text") >= length)
    left = stored(repeated_cores(anchors(src, length, core)), "slots")
    release(spark)

    place = F.struct("k1", "k2", "start", "width")
    kinds = stored(left.groupBy("core", "slot").agg(F.sum("copies").alias("n"), F.min(place).alias("rep")), "slot-kinds")
    several = kinds.where("n > 1").select(F.col("core").alias("_core"), F.col("slot").alias("_slot"))
    same = F.col("core") == F.col("_core")
    whole = left.join(several, same & (F.col("slot") == F.col("_slot")), "left_semi")
    bounds = ["k1", "k2", F.col("start").alias("a"), (F.col("start") + F.col("width") - 1).alias("z")]
    ranges = [stored(whole.select(F.lit(0).alias("kind"), *bounds), "whole-slots"), word_left.where("shared").select(F.lit(1).alias("kind"), *bounds)]
    open_ = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select(F.col("core").alias("_core"))
    asked = kinds.join(open_, same, "left_semi").select(F.lit(0).alias("kind"), "rep.*")
    asked = asked.unionByName(word_left.where("kind IS NOT NULL").drop("shared")).groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(
        F.collect_list(F.struct("kind", "start", "width")).alias("slots"))
    asked = stored(asked, "open-slots")
    release(spark)

    # one text for each key: copies already have their ranges, and collapse before the shuffle
    texts = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    of_text = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    pairs = window_pairs(texts.join(asked, of_text).select("k1", "k2", "text", "slots"), length, words)
    # bytes: the window starts twice; words: it is in two texts, or in a slot that two documents hold
    of_name = Window.partitionBy("n1", "n2", "kind")
    pairs = pairs.withColumns({"n": F.count("*").over(of_name), "apart": F.min("k1").over(of_name) < F.max("k1").over(of_name), "least": F.min("p").over(of_name)})
    single = pairs.where("p >= 0 AND CASE kind WHEN 0 THEN n > 1 ELSE apart OR least < 0 END")
    ranges.append(stored(single.select("kind", "k1", "k2", F.col("p").alias("a"), F.col("p").alias("z")), "single-starts"))
    release(spark)
    of_kind = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.struct("a", "z")))
    out = reduce(DataFrame.unionByName, ranges).groupBy("k1", "k2").agg(of_kind(0).alias("ranges"), covered(of_kind(1), words).alias("n_shared_words"))
    out = stored(out, "ranges")
    release(spark)
    return out


def cut(docs: DataFrame, ranges: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` in a struct ``_row``, then ``n_bytes``, ``n_removed``, ``n_spans``, ``n_shared_words`` and ``kept`` (the bytes left)."""
    t = F.col(f"`{text}`")
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *text_key(t))
    marks = ranges.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "ranges", F.col("n_shared_words").alias("_shared"))
    both = src.join(marks, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").select("_row", "ranges", F.coalesce("_shared", F.lit(0)).alias("n_shared_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text_, own in zip(b.column("_row").field(text), b.column("ranges")):
                data = _bytes(text_.as_py())
                spans = 0
                rest = data
                if own.is_valid:
                    change = np.zeros(len(data) + 1, dtype=np.int64)
                    np.add.at(change, own.values.field("a").to_numpy(zero_copy_only=False), 1)
                    np.add.at(change, own.values.field("z").to_numpy(zero_copy_only=False) + length, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rest = data[~gone]
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(rest))
                n_spans.append(spans)
                kept.append(rest.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                              b.column("n_shared_words"), pa.array(kept, pa.binary())], ["_row", "n_bytes", "n_removed", "n_spans", "n_shared_words", "kept"])

    return both.mapInArrow(run, row_and(both, "n_bytes long, n_removed long, n_spans long, n_shared_words long, kept binary"))


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = cut(docs, repeated_starts(docs))
    return out.select("_row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared_words")
