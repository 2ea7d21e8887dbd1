"""Operator 13, target-distribution importance resampling over hashed n-grams.

An untrained pre-tokeniser (a Regex Split of the ``tokenizers`` library) cuts the A-Z-lowered text into words and
their byte offsets.  Features are the windows of 1 to 3 neighbouring offset pairs, the words joined by one space; a
feature's bucket is the CRC-32 of its bytes modulo ``buckets``.  Checksums of windows are combined from those of their
words (a checksum is linear over GF(2)), so no n-gram string is ever made.

The documents are read once: their buckets (two bytes a feature) are stored in the shared folder, since pre-tokenising
again costs more than reading them; one pass over them counts buckets (every task sends one histogram), another sums
the gains of a document's features.  A bucket's gain is floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) with s
of S features of the documents, t of T of the target texts and B buckets; a document's weight is the sum of its gains,
its score the weight plus a Gumbel number from a hash of its id.  The highest scores of the documents of at least
``min_words`` words are drawn: a Gumbel-top-k sample, without replacement, in proportion to exp(weight / 1000).  Ranks
come from one range-partitioned sort of narrow rows, never from one task.

Defined results: null text, or text without a word -> 0 features, weight 0, never drawn.  A null id hashes as the
empty string and ties of score go to the smaller id (null last), then to fewer features; repeated rows are documents
of their own and may each be drawn.  With an empty target every T and t is 0; an empty table gives no row.  Only the
named columns are read; others ride along in ``_row``.  Long texts are pre-tokenised in segments cut between words.
"""

from __future__ import annotations

import gc
import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import sorted_index
from .common import LOWER, bounded_batches, chunks, read, row_and, stored

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 3  # words of a feature
BUCKETS = 10_000
SLICE_BYTES, SEGMENT = 4 << 20, 1 << 20
STEPS = 48  # longer words are left to zlib

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_splitter: list = []


def _offsets(text: bytes) -> np.ndarray:
    """(words, 2) byte offsets of the words of a lowered text: what the delimiters leave."""
    from tokenizers import PreTokenizedString, Regex, pre_tokenizers

    if not _splitter:
        _splitter.append(pre_tokenizers.Split(Regex(DELIMITERS), behavior="removed"))
    pieces = PreTokenizedString(text.decode("utf-8"))
    _splitter[0].pre_tokenize(pieces)
    gc.disable()  # millions of small tuples without cycles: walking them costs more than making them
    try:
        found = pieces.get_splits(offset_referential="original", offset_type="byte")
        return np.fromiter(chain.from_iterable([p[1] for p in found]), dtype=np.int64, count=2 * len(found)).reshape(-1, 2)
    finally:
        gc.enable()


def word_offsets(text: bytes, segment: int = SEGMENT) -> np.ndarray:
    """(words, 2) byte offsets; a text longer than ``segment`` is cut before bytes that are in no word."""
    found, at = [], 0
    while at < len(text):
        end = at + segment
        while end < len(text) and IS_WORD[text[end]]:
            end += 1
        found.append(_offsets(text[at:end]) + at)
        at = end
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, np.uint32(0xEDB88320) ^ (t >> 1), t >> 1).astype(np.uint32)
    return t


def _columns(image: np.ndarray) -> np.ndarray:
    """[byte number, byte]: a linear map of checksums, given by the images of their 32 bits, by bytes."""
    bit = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return np.stack([np.bitwise_xor.reduce(np.where(bit, image[8 * i:8 * i + 8], 0).astype(np.uint32), axis=1) for i in range(4)])


def _applied(table: np.ndarray, crc: np.ndarray, row: np.ndarray | int = 0) -> np.ndarray:
    """The maps number ``row`` of a flat table, applied to checksums."""
    base, x = row * 1024, crc.astype(np.int64)
    return (table[base + (x & 0xFF)] ^ table[base + 256 + ((x >> 8) & 0xFF)]
            ^ table[base + 512 + ((x >> 16) & 0xFF)] ^ table[base + 768 + (x >> 24)])


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """What appending n < SHORT bytes, and what appending 2^k bytes, makes of a checksum."""
    bits = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)
    one = _columns(CRC[bits & 0xFF] ^ (bits >> np.uint32(8))).ravel()  # one zero byte
    short, image = [], bits
    for _ in range(SHORT):
        short.append(_columns(image).ravel())
        image = _applied(one, image)
    double = [one]
    for _ in range(30):
        double.append(_columns(_applied(double[-1], _applied(double[-1], bits))).ravel())
    return np.concatenate(short), np.stack(double)


SHORT = 64
CRC = _crc_table()
SHIFT, DOUBLE = _shift_tables()
SPACE = zlib.crc32(b" ")


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The part that a checksum adds when ``size`` bytes follow: crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)."""
    out = _applied(SHIFT, crc, size & (SHORT - 1))
    large = np.flatnonzero(size >= SHORT)
    for k in range(6, int(size[large].max()).bit_length() if len(large) else 0):
        on = large[np.flatnonzero((size[large] >> k) & 1)]
        out[on] = _applied(DOUBLE[k], out[on])
    return out


def word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range; all ranges advance together, the longest ones first."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    at, left = start[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(int(min(left[0], STEPS)) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, side="left"))  # ranges longer than j
        crc[:n] = CRC[(crc[:n] ^ data[at[:n] + j]) & 0xFF] ^ (crc[:n] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(int(np.searchsorted(-left, -STEPS, side="left"))):
        crc[i] = zlib.crc32(data[at[i]:at[i] + left[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def features(texts: list[bytes], buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for every feature length (text, bucket) of all features."""
    low = [LOWER[np.frombuffer(t, dtype=np.uint8)].tobytes() for t in texts]
    spans = [word_offsets(t) for t in low]
    base = np.cumsum([0, *map(len, low)])
    data = np.frombuffer(b"".join(low), dtype=np.uint8)
    n = np.array([len(s) for s in spans], dtype=np.int64)
    where = np.concatenate([s + b for s, b in zip(spans, base)]) if spans else np.zeros((0, 2), np.int64)
    text = np.repeat(np.arange(len(texts)), n)
    own = word_crcs(data, where[:, 0], where[:, 1])
    size = where[:, 1] - where[:, 0] + 1
    after_space = shifted(np.full(len(own), SPACE, dtype=np.uint32), size - 1) ^ own
    out, crc, of = [], own, text
    for m in range(longest):
        if m:  # windows of one word more: the next offset pair, if it is in the same text
            last = np.arange(len(crc) - 1) + m
            crc = shifted(crc[:-1], size[last]) ^ after_space[last]
            of = np.where(of[:-1] == text[last], of[:-1], -1)
        ok = of >= 0
        out.append((of[ok], (crc[ok] % np.uint32(buckets)).astype(np.int64)))
        if len(crc) < 2:
            break
    return n, out


def _texts(column: pa.Array) -> list[bytes]:
    return [(x or "").encode("utf-8", "replace") for x in column.to_pylist()]


FEATURES = "n_words long, n_features long, buckets binary"


def featured(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None, buckets: int = BUCKETS,
             longest: int = LONGEST) -> DataFrame:
    """Columns ``carry`` (none: all) of ``docs`` in a struct ``_row``, then n_words, n_features and the features'
    bucket numbers as two-byte integers; stored in the shared folder."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets: 1 to 65536")
    bounded_batches(docs.sparkSession)
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column("_text"))
            words, count, raw = [], [], []
            for part in chunks(map(len, texts), SLICE_BYTES):
                n, found = features(texts[part], buckets, longest)
                of = np.concatenate([f[0] for f in found])
                bucket = np.concatenate([f[1] for f in found]).astype(np.uint16)[np.argsort(of, kind="stable")]
                each = np.bincount(of, minlength=len(n))
                end = np.cumsum(each)
                words += n.tolist()
                count += each.tolist()
                raw += [bucket[a:z].tobytes() for a, z in zip((end - each).tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(words, pa.int64()), pa.array(count, pa.int64()), pa.array(raw, pa.binary())],
                                             ["_row", "n_words", "n_features", "buckets"])

    return stored(src.mapInArrow(run, row_and(src, FEATURES)), "features")


def _numbers(column: pa.Array) -> np.ndarray:
    """All bucket numbers of a batch."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16)


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``featured`` rows by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            seen += np.bincount(_numbers(b.column("buckets")), minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    table = rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket from the histograms of the documents and of the target texts."""
    b, total_s, total_t = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (total_s + b) / ((s + 1) * (total_t + b))))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], dtype=np.int64)


def weighted(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """``featured`` rows with ``weight``, the sum of their features' gains, in place of the features."""
    sent = rows.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.concatenate(([0], np.cumsum(sent.value[_numbers(b.column("buckets"))])))
            end = np.cumsum(b.column("n_features").to_numpy())
            weight = sums[end] - sums[end - b.column("n_features").to_numpy()]
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("n_words"), b.column("n_features"), pa.array(weight)],
                                             ["_row", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, row_and(rows, "n_words long, n_features long, weight long"))


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)), u in (0, 1) from 32 bits of sha256(seed:key)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def drawn(rows: DataFrame, key: str = "doc_id", percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """``weighted`` rows with ``score`` and ``rank``: 1, 2, 3, ... for the floor(percent * N / 100) highest scores of the
    N rows of at least ``min_words`` words, null for all others."""
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col(f"_row.`{key}`"), seed)), "weighted")
    may = F.col("n_words") >= min_words
    take = rows.where(may).count() * percent // 100
    # equal rows are spread by their position in the stored table
    order = [F.col("score").desc(), F.col(f"_row.`{key}`").asc_nulls_last(), F.col("n_features"), F.col("_salt")]
    ranked = sorted_index(rows.where(may).withColumn("_salt", F.monotonically_increasing_id()), order, index_col="rank").drop("_salt")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < take, F.col("rank") + 1).cast("long"))
    return ranked.unionByName(rows.where(~may).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
              percent: int = 5, min_words: int = 20, seed: int = 42, carry: Sequence[str] | None = None) -> DataFrame:
    """Every document (columns ``carry``, none: all, in ``_row``) with n_words, n_features, weight, score and rank."""
    rows = featured(docs, text, carry)
    gains = bucket_gains(histogram(rows), histogram(featured(target, target_text, [target_text])))
    return drawn(weighted(rows, gains), key, percent, min_words, seed)


def op13_importance(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = resampled(docs, read(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select("_row.doc_id", "n_features", "weight", "score", "rank")
