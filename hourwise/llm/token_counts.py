"""Operator 5, token counts by offset-mapped attribution.

A document is rendered once from its fields and encoded once, whole.  Token character spans are joined with the
spans of the fields (or of any sections given): both are sorted, so each token finds its section by binary search.
A token lies in one section unless it crosses a boundary; such a token is allocated by an explicit rule:

* ``most`` (default): the section that holds most of its characters; ties go to the earlier section;
* ``first``: the section that holds its first character.

Characters outside all sections (separators) form the section ``between``, which takes part like any other.  A token
that holds only some bytes of a character counts as spanning that character.

Encoding: the public byte-level pattern splits a text into pieces; a piece's tokens are found once and remembered (a
bounded cache per worker).  The vocabulary file is read by the driver from a path that is a parameter and sent to the
tasks; its size does not depend on the input.

Defined results: null field -> empty section with 0 tokens (its separator stays); an empty document has 0 tokens;
empty tables give no rows; repeated rows are each counted; other columns ride along untouched, whatever their names.
Runs of any length (spaces, one repeated letter) are encoded whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, row_and

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the public split pattern of the byte-level vocabulary (white space written as a Unicode property).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

CACHED_PIECES, CACHED_CHARS = 400_000, 64


class Lengths:
    """Byte lengths of a text's tokens, in order."""

    def __init__(self, vocabulary: bytes):
        import regex
        import tiktoken

        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, vocabulary.splitlines()) if t}
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.uint16)
        for token, n in ranks.items():
            self.size[n] = len(token)
        self.core = tiktoken.Encoding("pieces", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}

    def of_piece(self, piece: str) -> bytes:
        got = self.known.get(piece)
        if got is None:
            got = self.size[self.core._encode_single_piece(piece)].tobytes()
            if len(piece) <= CACHED_CHARS:
                if len(self.known) >= CACHED_PIECES:
                    self.known.clear()
                self.known[piece] = got
        return got

    def __call__(self, text: str) -> np.ndarray:
        pieces = self.split(text)
        known = self.known
        try:
            found = b"".join([known[p] for p in pieces])
        except KeyError:
            found = b"".join(map(self.of_piece, pieces))
        return np.frombuffer(found, dtype=np.uint16)


def char_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every token, in characters."""
    end = np.cumsum(lengths, dtype=np.int64)
    start = end - lengths
    if len(end) and end[-1] == len(text):  # one byte a character
        return start, end
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    return (char[start], char[end - 1] + 1) if len(end) else (start, end)


def allocate(start: np.ndarray, end: np.ndarray, sections: list[tuple[int, int]], n: int, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section and, last, of ``between``; number of tokens that cross a boundary.  Sections are sorted
    and do not overlap; empty ones get nothing."""
    k = len(sections)
    edges, owner, at = [], [], 0
    for i, (a, b) in enumerate(sections):
        if a > at:
            edges.append(at)
            owner.append(k)
        if b > a:
            edges.append(a)
            owner.append(i)
        at = max(at, b)
    if at < n or not edges:
        edges.append(at)
        owner.append(k)
    e, o = np.array(edges), np.array(owner)
    first, last = np.searchsorted(e, start, side="right") - 1, np.searchsorted(e, end - 1, side="right") - 1
    got = first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        bounds = np.append(e, n)
        for t in crossing.tolist():
            parts = range(first[t], last[t] + 1)
            shares: dict[int, int] = {}
            for p in parts:
                shares[o[p]] = shares.get(o[p], 0) + int(min(end[t], bounds[p + 1]) - max(start[t], bounds[p]))
            best = max(shares.values())
            got[t] = next(p for p in parts if shares[o[p]] == best)
    elif rule != "first":
        raise ValueError(f"no such rule: {rule}")
    return np.bincount(o[got], minlength=k + 1), len(crossing)


def count_tokens(docs: DataFrame, fields: tuple[str, ...] = ("source", "lang", "text"), separator: str = "\n",
                 sections: str | None = None, rule: str = "most", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` in a struct ``_row``, then ``n_tokens``, ``tokens`` (one count for each section, then ``between``) and
    ``n_crossing``.  The document is its fields, joined by ``separator``, and these are its sections; or ``sections``
    names a column of sorted array<struct<start, end>> (characters of the only field)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    if rule not in ("most", "first"):
        raise ValueError(f"no such rule: {rule}")
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    ready: list[Lengths] = []
    own = [F.col(f"`{c}`").cast("string").alias(f"_f{i}") for i, c in enumerate(fields)]
    given = [F.col(f"`{sections}`").alias("_sections")] if sections else []
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *own, *given)
    has_sections = bool(given)
    schema = row_and(src, "n_tokens long, tokens array<long>, n_crossing long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not ready:
            ready.append(Lengths(sent.value))
        for b in batches:
            columns = [[x or "" for x in b.column(f"_f{i}").to_pylist()] for i in range(len(fields))]
            marked = b.column("_sections").to_pylist() if has_sections else None
            n_tokens, tokens, crossing = [], [], []
            for r, values in enumerate(zip(*columns)):
                text = separator.join(values)
                if marked is not None:
                    spans = [(s["start"], s["end"]) for s in marked[r] or ()]
                else:
                    at = np.cumsum([0] + [len(v) + len(separator) for v in values])
                    spans = [(int(a), int(a) + len(v)) for a, v in zip(at, values)]
                start, end = char_spans(text, ready[0](text))
                counts, crossed = allocate(start, end, spans, len(text), rule)
                n_tokens.append(len(start))
                tokens.append(counts.tolist())
                crossing.append(crossed)
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.array(n_tokens, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(crossing, pa.int64())],
                ["_row", "n_tokens", "tokens", "n_crossing"])

    return src.mapInArrow(run, schema)


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    out = count_tokens(docs)
    return out.select("_row.doc_id", "n_tokens", *[F.col("tokens")[i].alias(f"tokens_{n}") for i, n in
                                                  enumerate(("source", "lang", "text", "between"))], "n_crossing")
