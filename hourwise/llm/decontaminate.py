"""Operator 3, benchmark decontamination: Wu-Manber multi-pattern search over words.

A text is its words, A-Z lower-cased: maximal runs of bytes other than ASCII non-alphanumerics.  Patterns are the
windows of 13 consecutive words of the benchmark items; an item of 1 to 12 words is one shorter pattern.  Patterns of
one length m are searched together: a block is two neighbouring words; the shift table gives, for the block at the
end of the current position, how far the position may move without passing an occurrence (m - 1 words for a block
that no pattern holds); where the shift is 0, the suffix hash selects the patterns that end in that block, and a
direct comparison of the words' bytes confirms.  All texts of a slice advance together, each by its own shift.

Patterns are handed to the tasks in blocks of at most ``block_bytes``, whose number comes from their total size: one
pass over the documents per block (a single one for any usual benchmark), so what is broadcast is bounded however
large the benchmark table is; passes are joined by merging the hit spans each row carries.

Defined results: null text and text without words -> 0 words, 0 hits, not contaminated.  Items with null or wordless
text hold no pattern.  Items with a null id mark words as hit but are not counted or listed as items; repeated item
ids are one item, with the windows of all its rows.  Repeated documents are each judged.  An empty benchmark hits
nothing.  Only the named columns are read; other columns ride along untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, LOWER, RollingHash, ascii_lower, bounded_batches, chunks, flat_bytes, mixed, runs, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SLICE_BYTES = 4 << 20
SHIFT_CELLS = 1 << 18  # cells of a shift table; a shared cell keeps the smaller shift, which is always safe

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(pattern, ids): every distinct window, its words joined by single spaces, with the sorted ids of its items."""
    words = F.regexp_extract_all(ascii_lower(F.col(f"`{text}`")), F.lit(WORD), 0)
    w = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), words.alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    each = w.select("id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(
        F.slice("w", i + 1, F.lit(window)), " "))).alias("pattern"))
    return each.groupBy("pattern").agg(F.sort_array(F.collect_set("id")).alias("ids"))


class Tokens:
    """Words of many texts: the squeezed bytes (lower-cased words, one space after each), each word's range and hash."""

    def __init__(self, texts: list[bytes]):
        data, starts = flat_bytes(texts)
        data = LOWER[data]
        s, e = runs(IS_WORD[data])
        self.text = np.searchsorted(starts, s, side="right") - 1
        keep = IS_WORD[data]
        keep[e] = True  # one separator
        squeezed = np.where(IS_WORD[data], data, np.uint8(32))[keep]
        size = e - s
        self.start = np.cumsum(size + 1) - (size + 1)
        self.end = self.start + size
        self.bytes = squeezed.tobytes()
        self.hash = mixed(RollingHash(squeezed)(self.start, self.end)) if len(s) else np.zeros(0, np.uint64)
        self.count = np.bincount(self.text, minlength=len(texts)) if len(s) else np.zeros(len(texts), np.int64)
        self.first = np.cumsum(self.count) - self.count


def block_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(BASE) + b)


class WuManber:
    """Shift table and suffix buckets of the patterns of one length of m words."""

    def __init__(self, patterns: list[bytes], numbers: list[int], m: int):
        self.m = m
        t = Tokens(patterns)
        h = t.hash.reshape(-1, m)
        b = 2 if m >= 2 else 1
        self.block = b
        ends = np.arange(b - 1, m)
        blocks = h if b == 1 else block_hash(h[:, :-1], h[:, 1:])
        self.shift = np.full(SHIFT_CELLS, m - b + 1, dtype=np.int32)
        np.minimum.at(self.shift, (blocks & np.uint64(SHIFT_CELLS - 1)).ravel(), np.tile((m - 1 - ends).astype(np.int32), len(h)))
        suffix = blocks[:, -1]
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.order = suffix[order], order
        self.whole = self.window_hash(h)
        self.patterns, self.numbers = patterns, numbers

    @staticmethod
    def window_hash(h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=np.uint64)
        for j in range(h.shape[1]):
            out = out * np.uint64(BASE) + h[:, j]
        return out

    def search(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(word at which an occurrence starts, pattern number) of every occurrence."""
        m, places, found = self.m, [], []
        text = np.flatnonzero(t.count >= m)
        pos = t.first[text] + m - 1  # last word of the current position
        last = t.first[text] + t.count[text] - 1
        while len(pos):
            block = t.hash[pos] if self.block == 1 else block_hash(t.hash[pos - 1], t.hash[pos])
            shift = self.shift[(block & np.uint64(SHIFT_CELLS - 1)).astype(np.int64)]
            at = np.flatnonzero(shift == 0)
            if len(at):
                lo = np.searchsorted(self.suffix, block[at], side="left")
                n = np.searchsorted(self.suffix, block[at], side="right") - lo
                if n.any():
                    start = np.repeat(pos[at] - m + 1, n)
                    j = self.order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                    h = t.hash[start[:, None] + np.arange(m)]
                    same = np.flatnonzero(self.window_hash(h) == self.whole[j])
                    for s, k in zip(start[same].tolist(), j[same].tolist()):
                        if t.bytes[t.start[s]:t.end[s + m - 1]] == self.patterns[k]:
                            places.append(s)
                            found.append(self.numbers[k])
            pos = pos + np.maximum(shift, 1)
            on = pos <= last
            pos, last = pos[on], last[on]
        return np.array(places, dtype=np.int64), np.array(found, dtype=np.int64)


class Searcher:
    """All patterns of a block, by their number of words."""

    def __init__(self, patterns: list[str], ids: list[list[str]]):
        self.ids = ids
        by: dict[int, list[int]] = {}
        for i, p in enumerate(patterns):
            by.setdefault(p.count(" ") + 1, []).append(i)
        self.tables = [WuManber([patterns[i].encode() for i in own], own, m) for m, own in sorted(by.items())]

    def search(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Of each text: number of words, merged hit spans (in words, end exclusive), ids of the items found."""
        out = []
        for part in chunks(map(len, texts), SLICE_BYTES):
            t = Tokens(texts[part])
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for table in self.tables:
                at, found = table.search(t)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                of = t.text[at]
                for i in order.tolist():
                    spans.setdefault(int(of[i]), []).append((int(at[i] - t.first[of[i]]), int(at[i] - t.first[of[i]]) + table.m))
                    items.setdefault(int(of[i]), set()).update(self.ids[int(found[i])])
            out += [(int(t.count[i]), merged(spans.get(i, [])), items.get(i, set())) for i in range(part.stop - part.start)]
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SPANS = "array<struct<start:int,end:int>>"
_span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, block_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` in a struct ``_row``, then ``n_words``, ``hits`` (merged spans of hit words) and ``items`` (sorted ids)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    patterns = stored(windows(benchmark, item_id, item_text, window), "windows")
    weight = F.octet_length("pattern") + 24 + F.aggregate("ids", F.lit(0), lambda a, x: a + F.length(x) + 8)
    total = patterns.agg(F.sum(weight.cast("long"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("hits"),
                      F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        own = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k).orderBy("pattern").toArrow()
        sent = spark.sparkContext.broadcast((own["pattern"].to_pylist(), own["ids"].to_pylist()))
        ready: list[Searcher] = []

        def run(batches: Iterator[pa.RecordBatch], sent=sent, ready=ready) -> Iterator[pa.RecordBatch]:
            if not ready:
                ready.append(Searcher(*sent.value))
            for b in batches:
                texts = [(x or "").encode("utf-8", "replace") for x in b.column("_text").to_pylist()]
                found = ready[0].search(texts)
                hits = [merged([(s["start"], s["end"]) for s in old] + f[1]) for old, f in zip(b.column("hits").to_pylist(), found)]
                items = [sorted(f[2].union(old)) for old, f in zip(b.column("items").to_pylist(), found)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("_row"), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([[{"start": a, "end": z} for a, z in h] for h in hits], _span_type),
                     pa.array(items, pa.list_(pa.string()))], ["_row", "n_words", "hits", "items"])

        src = out.withColumn("_text", F.col("_row").getField(text))
        out = src.mapInArrow(run, out.schema)
        out = stored(out, "searched") if k + 1 < blocks else out
    return out


def judged(found: DataFrame) -> DataFrame:
    """``find_windows`` output with ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = judged(find_windows(docs, read(spark, sf_dir, "benchmark")))
    return found.select("_row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLE = rf"""
WITH bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark),
windows AS (SELECT item_id, least(len(w), {WINDOW}) AS m, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS pattern
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM windows),
dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w FROM documents),
places AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m)),
found AS (SELECT doc_id, p.m, i, item_id FROM places p JOIN windows USING (pattern)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
