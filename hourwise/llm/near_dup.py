"""Operator 10, MinHash near-dedup by fast similarity sketching.

A document's set: its distinct shingles of ``words`` consecutive words (A-Z lower-cased; a document of fewer words is
one shingle; without words: empty).  Documents with equal sets form one class, and only classes go on.

Sketch of t bins: in round i < t every element is hashed to one bin with a value in [i, i + 1); in round t + j every
element is hashed to bin j, so after 2t rounds at the latest every bin is filled; a bin keeps its least value and a
set stops at the first round after which all its bins are filled.  The share of equal bins of two sets estimates
their similarity with the concentration of independent MinHashes.  ``rows`` bins make a band key; classes that share
a key are candidates.  With 192 bins in 32 bands of 6, a pair at similarity 0.85 shares no band with probability
(1 - 0.85^6)^32 = 3e-7; at other thresholds the number of rows follows from the same bound (``band_rows``).

Candidates are confirmed on full sets.  No bucket is expanded into all its pairs:

1. Every member is compared with the bucket's hub, the member that shares the most buckets (the original of a group
   of near copies, say).  Connected components of the links found settle most buckets.
2. Buckets whose members are still in different components are split exactly.  Let a member differ from its hub o by
   the shingles A (added) and R (removed).  |x ^ y| = |Dx ^ Dy| with D = A + R (^: symmetric difference), so x and y
   can only be linked if Dx and Dy overlap in at least m = (|Dx| + |Dy| - t (|x| + |y|)) / 2 elements, where
   t = (1 - s) / (1 + s).  Two members of different components are not both linked to the hub, and if x is not,
   |Dx| > t (|x| + |o|), hence m > (|Dy| - t (|Ay| - |Ry|)) / 2.  Nor do linked sets differ by more than (1/s - 1) |y|
   elements, so m >= |Dy| - (1/s - 1) |y|.  By prefix filtering, linked members share one of the first |D| - m + 1
   elements of each D in any common order.  The order is by rarity among the hub's members, so what
   many of them share (a phrase added everywhere, a passage left out everywhere) comes last and is hardly ever among
   these: what is left are deviations shared by few.  They are the keys of new buckets (for each hub), which take a star
   too.
3. At last the pairs of different components in one such bucket that were never compared are compared, if what follows
   the shared key in both orders leaves room for m shared elements.

Every step is lossless for pairs that share a band, and nothing is capped.

Defined results: null text or no words -> n_shingles 0, a component of its own; a null id never names a component
while a member has an id (it is null if none has); repeated ids are one id, repeated rows one class.  ``kept`` is
true where id and component id are equal (or both null).  An empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, LOWER, RollingHash, bounded_batches, chunks, flat_bytes, mixed, read, release, runs, stored

SLICE_BYTES = 4 << 20
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ROUND = np.uint64(0xD6E8FEB86659FD93)
EMPTY = np.uint64(2**64 - 1)


class Sets:
    """Distinct shingle hashes of many texts, sorted in each text; ``first`` and ``count`` by text."""

    def __init__(self, texts: list[bytes], words: int):
        # texts are kept apart by a space: no byte of a text is taken for a separator that is none
        data = LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        starts = np.cumsum(sizes) - sizes
        s, e = runs(IS_WORD[data])
        w = mixed(RollingHash(data)(s, e)) if len(s) else np.zeros(0, np.uint64)
        of = np.searchsorted(starts, s, side="right") - 1
        n = np.bincount(of, minlength=len(texts)) if len(s) else np.zeros(len(texts), np.int64)
        at = np.cumsum(n) - n
        hashes, owners = [], []
        for m in range(1, words + 1):
            if m < words:
                start = at[n == m]
            else:
                start = np.flatnonzero(np.arange(len(w)) + words <= (at + n)[of]) if len(w) else np.zeros(0, np.int64)
            if len(start):
                h = np.zeros(len(start), dtype=np.uint64)
                for j in range(m):
                    h = h * np.uint64(BASE) + w[start + j]
                hashes.append(mixed(h + np.uint64(m)))
                owners.append(of[start])
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        o = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        order = np.lexsort((h, o))
        h, o = h[order], o[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
        self.hash, self.text = h[new], o[new]
        self.count = np.bincount(self.text, minlength=len(texts)) if len(h) else np.zeros(len(texts), np.int64)
        self.first = np.cumsum(self.count) - self.count

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.first[i]:self.first[i] + self.count[i]]


def class_keys(sets: Sets) -> list[bytes | None]:
    """128-bit name of each set (None: empty), from sums that do not depend on the order of its elements."""
    at = np.flatnonzero(sets.count)
    out: list[bytes | None] = [None] * len(sets.count)
    if len(at):
        names = np.empty((len(at), 2), dtype=">u8")
        for j, c in enumerate((np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))):
            names[:, j] = mixed(np.add.reduceat(mixed(sets.hash ^ c), sets.first[at]) + sets.count[at].astype(np.uint64))
        raw = names.tobytes()
        for k, i in enumerate(at.tolist()):
            out[i] = raw[16 * k:16 * k + 16]
    return out


def sketches(sets: Sets, bins: int) -> np.ndarray:
    """(non-empty texts, bins): least (round, value) of each bin."""
    texts = np.flatnonzero(sets.count)
    out = np.full((len(texts), bins), EMPTY, dtype=np.uint64)
    if not len(texts):
        return out
    flat = out.reshape(-1)
    active = np.arange(len(texts))
    h, count = sets.hash, sets.count[texts]
    for i in range(2 * bins):
        x = mixed(h + np.uint64((i + 1) * int(ROUND) % (1 << 64)))
        value = (np.uint64(i) << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
        if i < bins:
            bin_of = ((x >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
            np.minimum.at(flat, np.repeat(active * bins, count) + bin_of.astype(np.int64), value)
        else:
            least = np.minimum.reduceat(value, np.cumsum(count) - count)
            out[active, i - bins] = np.minimum(out[active, i - bins], least)
        open_ = (out[active] == EMPTY).any(axis=1)
        if not open_.any():
            break
        if not open_.all():
            h = h[np.repeat(open_, count)]
            active, count = active[open_], count[open_]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands): one 64-bit key for each ``rows`` neighbouring bins."""
    n, bins = sketch.shape
    parts = sketch[:, :bins - bins % rows].reshape(n, -1, rows)
    key = np.zeros(parts.shape[:2], dtype=np.uint64)
    for j in range(rows):
        key = key * np.uint64(BASE) + mixed(parts[:, :, j])
    return mixed(key + np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * ROUND).view(np.int64)


def band_rows(percent: int, bins: int, miss: float = 1e-6) -> int:
    """Most rows of a band with which a pair at the threshold shares no band with probability ``miss`` at most: 6 at a
    similarity of 0.85, 5 at 0.8 (192 bins)."""
    fits = [r for r in range(1, bins + 1) if (1 - (percent / 100) ** r) ** (bins // r) <= miss]
    return max(fits, default=1)


def row_key(id_: Column, text: Column) -> list[Column]:
    """Two never-null hashes that name a row by id and text."""
    null = F.struct(id_.isNull().alias("a"), text.isNull().alias("b"))
    return [F.xxhash64(id_, text, null).alias("r1"), F.xxhash64(F.lit("row"), null, text, id_).alias("r2")]


def signatures(docs: DataFrame, key: str, text: str, words: int, bins: int, rows: int) -> DataFrame:
    """(id, r1, r2, cls, n, bands) of every row; cls and bands are null for an empty set."""
    bounded_batches(docs.sparkSession)
    id_, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    src = docs.select(id_.alias("id"), *row_key(id_, t), t.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(x or "").encode("utf-8", "replace") for x in b.column("text").to_pylist()]
            cls: list = []
            n: list = []
            bands: list = []
            for part in chunks(map(len, texts), SLICE_BYTES):
                sets = Sets(texts[part], words)
                cls += class_keys(sets)
                n += sets.count.tolist()
                keys = iter(band_keys(sketches(sets, bins), rows))
                bands += [next(keys) if c else None for c in sets.count.tolist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("r1"), b.column("r2"), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "r1", "r2", "cls", "n", "bands"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, r1 long, r2 long, cls binary, n long, bands array<long>")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, text_a, text_b).  A pair meets b's text by b, then a's by a: where many pairs share one a, that join's
    partition is split at run time and a's one row repeated."""
    own = texts.select(F.col("cls").alias("_cls"), F.col("text").alias("_text"))
    with_b = pairs.join(own, F.col("b") == F.col("_cls")).select("a", "b", F.col("_text").alias("text_b"))
    return with_b.join(own, F.col("a") == F.col("_cls")).select("a", "b", F.col("_text").alias("text_a"), "text_b")


def compared(batch: pa.RecordBatch, words: int, what) -> Iterator[tuple[list, list, list]]:
    """For parts of a batch of ``with_texts``: names a, names b, and what(i, set of a, set of b, two hashes of a's
    name) of every pair i; the set of a text that occurs many times is made once."""
    a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
    ta, tb = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
    for part in chunks([len(x) + len(y) for x, y in zip(ta, tb)], SLICE_BYTES):
        first = {a[i]: ta[i] for i in range(part.start, part.stop)}
        place = {x: k for k, x in enumerate(first)}
        lead = Sets([x.encode("utf-8", "replace") for x in first.values()], words)
        other = Sets([x.encode("utf-8", "replace") for x in tb[part]], words)
        name = mixed(np.frombuffer(b"".join(first), dtype="<u8").reshape(-1, 2) + np.array([1, 2], dtype=np.uint64))
        yield a, b, [what(i, lead.of(place[a[i]]), other.of(i - part.start), name[place[a[i]]]) for i in range(part.start, part.stop)]


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked) of all pairs; linked: their full sets have 100 * intersection >= percent * union."""
    def linked(i: int, x: np.ndarray, y: np.ndarray, _) -> tuple[int, bool]:
        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return i, False
        common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
        return i, 100 * common >= percent * (len(x) + len(y) - common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, made in compared(batch, words, linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[i] for i, _ in made], pa.binary()), pa.array([b[i] for i, _ in made], pa.binary()), pa.array([k for _, k in made], pa.bool_())],
                    ["a", "b", "linked"])

    return with_texts(pairs, texts).mapInArrow(run, "a binary, b binary, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b) but the least of each component: the least node reachable.
    Alternating large-star and small-star steps, each round stored in the shared folder, until every node hangs on the
    least node of its component."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "_u")
        large = both.join(least, F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = large.join(least, F.col("u") == F.col("_u")).select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stored(small.where("u != v").distinct(), "stars")
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 OR (up = 1 AND down > 0)").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Bucket members (key, cls, n, w, short) with ``comp``, their component so far."""
    if labels is None:
        return members.withColumn("comp", F.col("cls"))
    return members.join(labels, F.col("cls") == F.col("node"), "left").select(*members.columns, F.coalesce("label", "cls").alias("comp"))


def mixed_buckets(members: DataFrame, *more: Column) -> DataFrame:
    """(_key, more) of the buckets in which two components or more may still meet."""
    split = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("short").alias("any"), *more).where("lo != hi AND any")
    return split.drop("lo", "hi", "any").withColumnRenamed("key", "_key")


def deviations(around: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(hub, key, cls, n, w, p1, p2) for every hub a and member b of the pairs ``around`` and every shingle in which b
    deviates from a.  Keys name the hub and the shingle.  The first p1 of a member's keys, in a common order, suffice
    for partners not linked to the hub, the first p2 for all."""
    def rows(i: int, hub: np.ndarray, own: np.ndarray, name: np.ndarray) -> tuple:
        p, q = 100 - percent, 100 + percent
        at = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
        shared = hub[at] == own
        added = own[~shared]
        gone = np.ones(len(hub), dtype=bool)
        gone[at[shared]] = False
        removed = hub[gone]
        d, common = len(added) + len(removed), int(shared.sum())
        far = 100 * common < percent * (len(hub) + len(own) - common)
        need = (d * q - p * (len(added) - len(removed))) // (2 * q) + 1
        p1 = p2 = max(0, d - need + 1)
        if far:
            need = max(1, -((p * (len(own) + len(hub)) - d * q) // (2 * q)))
            p2 = max(p1, d - need + 1)
        most = (100 - percent) * len(own) // percent + 1 if percent else d
        p1, p2 = min(p1, most), min(p2, most)
        return i, np.concatenate((mixed(added ^ name[0]), mixed(removed ^ name[1]))), len(own), -d, p1, p2, int(name[0].view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, b, made in compared(batch, words, rows):
                made = [r for r in made if r[5]]  # a member whose prefix is empty has no partner
                of = np.repeat(np.arange(len(made)), [len(r[1]) for r in made])
                keys = np.concatenate([r[1] for r in made]) if made else np.zeros(0, np.uint64)
                spread = lambda k: pa.array(np.array([r[k] for r in made], dtype=np.int64)[of])
                yield pa.RecordBatch.from_arrays(
                    [spread(6), pa.array(keys.view(np.int64)), pa.array([b[r[0]] for r in made], pa.binary()).take(pa.array(of)), *(spread(k) for k in (2, 3, 4, 5))],
                    ["hub", "key", "cls", "n", "w", "p1", "p2"])

    return with_texts(around, texts).mapInArrow(run, "hub long, key long, cls binary, n long, w long, p1 long, p2 long")


def rare_keys(fine: DataFrame) -> DataFrame:
    """Finer buckets: (key, cls, n, w, short, left), the prefixes of ``deviations`` in order of rarity; ``left`` keys
    follow.  A key of one member takes its place in the order but makes no bucket."""
    shared = fine.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").withColumnRenamed("key", "_key")
    held = fine.join(shared, F.col("key") == F.col("_key"))
    member = Window.partitionBy("hub", "cls")
    place = -F.col("w") - F.count("*").over(member) + F.row_number().over(member.orderBy("c", "key"))  # -w: all its keys
    return held.withColumn("place", place).where("place <= p2").select(
        "key", "cls", "n", "w", (F.col("place") <= F.col("p1")).alias("short"), (-F.col("w") - F.col("place")).alias("left"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                    bins: int = 192, rows: int | None = None) -> DataFrame:
    """(id, r1, r2, label, n_shingles, component_id, kept) for every row of ``docs``; r1 and r2 are its ``row_key``,
    label names its component (null: empty set).  ``rows`` of a band: none: see ``band_rows``."""
    spark = docs.sparkSession
    rows = rows or band_rows(percent, bins)
    sig = stored(signatures(docs, key, text, words, bins, rows), "signatures")
    least = F.min(F.struct("r1", "r2")).alias("rep")
    classes = sig.where("n > 0").groupBy("cls").agg(F.min("id").alias("least_id"), least, F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    exploded = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    weight = F.sum("c").over(Window.partitionBy("cls"))  # a class has no more rows than bands
    members = stored(exploded.join(shared, "key").select("key", "cls", "n", weight.alias("w"), F.lit(True).alias("short")), "members")
    release(spark)

    wanted = members.select(F.col("cls").alias("_cls")).distinct()
    reps = classes.join(wanted, F.col("cls") == F.col("_cls"), "left_semi").select("cls", "rep.r1", "rep.r2")
    t = F.col(f"`{text}`")
    rows_of = docs.where(t.isNotNull()).select(*[c.alias(f"_{n}") for c, n in zip(row_key(F.col(f"`{key}`"), t), ("r1", "r2"))], t.alias("text"))
    # one row of several equal ones, found where the join has brought them together
    texts = rows_of.join(reps, (F.col("_r1") == F.col("r1")) & (F.col("_r2") == F.col("r2"))).groupBy("r1", "r2", "cls").agg(F.first("text").alias("text"))
    texts = stored(texts.select("cls", "text"), "texts")
    release(spark)

    state = _Search(texts, words, percent)
    state.star(members)
    around = state.around_hubs(members)
    fine = stored(deviations(around, texts, words, percent), "deviations")
    if not fine.isEmpty():
        fine = stored(rare_keys(fine), "rare-keys")
        state.star(fine)
        state.rest(fine)
    labels = state.labels
    release(spark)

    named = classes.select("cls", "least_id")
    named = (named.join(labels, F.col("cls") == F.col("node"), "left") if labels is not None else named.withColumn("label", F.col("cls")))
    named = named.select("cls", "least_id", F.coalesce("label", "cls").alias("label"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id")).withColumnRenamed("label", "_label")
    by_class = named.join(ids, F.col("label") == F.col("_label")).select(F.col("cls").alias("_cls"), "label", "component_id")
    out = sig.select("id", "r1", "r2", "cls", "n").join(by_class, F.col("cls") == F.col("_cls"), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", "r1", "r2", "label", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


class _Search:
    """Components found so far, and the pairs compared."""

    def __init__(self, texts: DataFrame, words: int, percent: int):
        self.texts, self.words, self.percent = texts, words, percent
        self.labels: DataFrame | None = None
        self.tested: DataFrame | None = None

    def sizes(self) -> Column:
        return 100 * F.least("n", "_n") >= self.percent * F.greatest("n", "_n")

    def compare(self, pairs: DataFrame) -> None:
        """Confirm the pairs (a, b) that are new; a pair that is met both ways is compared once."""
        lo, hi = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
        pairs = pairs.select("a", lo, hi).groupBy("lo", "hi").agg(F.max(F.col("a") == F.col("lo")).alias("first"))
        if self.tested is not None:
            old = self.tested.select(F.least("a", "b").alias("_lo"), F.greatest("a", "b").alias("_hi"))
            pairs = pairs.join(old, (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi")), "left_anti")
        pairs = pairs.select(F.when(F.col("first"), F.col("lo")).otherwise(F.col("hi")).alias("a"), F.when(F.col("first"), F.col("hi")).otherwise(F.col("lo")).alias("b"))
        done = stored(confirmed(pairs, self.texts, self.words, self.percent), "pairs")
        self.tested = done if self.tested is None else self.tested.unionByName(done)
        found = done.where("linked").select("a", "b")
        if not found.isEmpty():
            # components found before go on as stars
            links = found if self.labels is None else found.unionByName(self.labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
            self.labels = components(links)

    def star(self, members: DataFrame) -> None:
        """Compare the members of every bucket that holds several components with its hub."""
        now = labelled(members, self.labels)
        lead = mixed_buckets(now, F.max(F.struct("w", "cls", "n", "comp", "short")).alias("l")).select(
            "_key", *[F.col(f"l.{c}").alias(f"_{c}") for c in ("cls", "n", "comp", "short")])
        pairs = now.join(lead, F.col("key") == F.col("_key")).where((F.col("comp") != F.col("_comp")) & (F.col("short") | F.col("_short")) & self.sizes())
        self.compare(pairs.select(F.col("_cls").alias("a"), F.col("cls").alias("b")))

    def around_hubs(self, members: DataFrame) -> DataFrame:
        """(a, b): the hub and each other member of the buckets that still hold several components."""
        now = labelled(members, self.labels)
        hubs = mixed_buckets(now, F.max(F.struct("w", "cls")).alias("l")).select("_key", F.col("l.cls").alias("a"))
        return now.join(hubs, F.col("key") == F.col("_key")).where("a != cls").select("a", F.col("cls").alias("b")).distinct()

    def rest(self, members: DataFrame) -> None:
        """Compare what is left: pairs of different components in one bucket."""
        now = labelled(members, self.labels)
        now = stored(now.join(mixed_buckets(now), F.col("key") == F.col("_key"), "left_semi"), "split-buckets")
        other = now.select(*[F.col(c).alias(f"_{c}") for c in now.columns])
        p, q = 100 - self.percent, 100 + self.percent
        # -w: all deviations of a member
        room = 2 * q * (F.least("left", "_left") + 1) >= -q * (F.col("w") + F.col("_w")) - p * (F.col("n") + F.col("_n"))
        pairs = now.join(other, F.col("key") == F.col("_key")).where(
            (F.col("cls") < F.col("_cls")) & (F.col("comp") != F.col("_comp")) & (F.col("short") | F.col("_short")) & self.sizes() & room)
        self.compare(pairs.select(F.col("_cls").alias("a"), F.col("cls").alias("b")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one of the smallest id; rows without words all stay."""
    found = near_duplicates(docs, key, text, words, percent)
    first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "r1", "r2")).alias("f")
    stay = found.where("label IS NOT NULL").groupBy("label").agg(first).select("f.r1", "f.r2", F.lit(True).alias("one"))
    stay = stay.unionByName(found.where("label IS NULL").select("r1", "r2", F.lit(False).alias("one")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(f"_{n}") for c, n in zip(row_key(F.col(f"`{key}`"), F.col(f"`{text}`")), ("r1", "r2"))])
    both = rows.join(stay, (F.col("_r1") == F.col("r1")) & (F.col("_r2") == F.col("r2")))
    # fully equal rows meet here: one of them stays
    nth = F.row_number().over(Window.partitionBy("r1", "r2").orderBy("one"))
    return both.withColumn("_nth", nth).where("NOT one OR _nth = 1").select("_row.*")


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, words=3, percent=85).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
r AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.to_id = e.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""
