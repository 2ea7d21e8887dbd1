"""Operator 9, mixing sources to target weights: Efraimidis-Spirakis sampling, in DataFrame operations only.

Sizes are words.  Sources, ordered by code point (null last), weigh 1, 2, 3, 1, ... and share the total of all sizes;
a target stops at ``max_epochs`` times its source's size and what it leaves is shared again by weight among the rest
(water filling, solved from running sums over the table of sources).  A target is met by complete epochs of the
source and a fractional selection: every document gets the exponential key -ln(u) / quality, u from a hash of its id;
documents are taken in key order while their running size stays nearest to what the epochs leave.

No source is ever sorted whole: keys fall into ``buckets`` classes of equal probability and sizes are summed by
(source, class) with partial aggregation.  The one class per source in which the budget ends is cut again between the
least and the greatest key that it really holds, until at most ``cut_rows`` rows are left to be ordered: whatever the
quality weights do to the keys, no class grows with its source.  Rows with equal keys are cut by a hash of the row,
equal rows by their number in ``spread``, if one is stored with them.

Defined results: null text or text without words -> size 0, taken 0; a null source is a source of its own, the last;
null, NaN or non-positive quality counts as 1; a row without an id draws by its text; rows with equal keys (repeated
ids) go by a hash of id, size and text, so reruns agree; an empty table gives no row.  A source's taken words differ
from its target by at most half of the document at the cut.  Other columns ride along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, stored

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
MAX_EPOCHS = 3
BUCKETS = 4096
CUT_ROWS = 100_000  # a larger class at the cut is cut again
BROADCAST_ROWS = 100_000  # a plan of more sources is joined by a shuffle


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def exponential_key(key: Column, quality: Column, seed: str = SEED) -> Column:
    """-ln(u) / quality with u in (0, 1) from 52 bits of md5(seed:key)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    good = quality.isNotNull() & ~F.isnan(quality) & (quality > 0)
    return F.least(-F.log(u) / F.when(good, quality).otherwise(1.0), F.lit(1e300))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with ``target``.  Its windows run over the table of sources, one row each."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("w", ((F.row_number().over(every) - 1) % 3 + 1).cast("double")).withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    at = w.withColumn("level", level).withColumn("capped", F.col("cap") / F.col("w") <= F.col("level"))
    share = F.max(F.when(~F.col("capped"), F.col("level"))).over(whole)
    return at.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * share).alias("target"))


KEYS = ("e", "tie", "spread")  # what rows are ordered by
LOWEST, HIGHEST = float("-inf"), float("inf")


def _ends_in(sums: DataFrame) -> DataFrame:
    """Of the classes of every ``of`` the one in which its ``budget`` ends, after ``before`` words.  The class is held
    as an interval of keys: ``level`` is the first key in which its rows differ, those before it have one value."""
    run = F.sum("size").over(Window.partitionBy("of").orderBy("class").rowsBetween(Window.unboundedPreceding, 0))
    after = F.col("before") + run
    at = sums.withColumn("after", after).where((F.col("after") >= F.col("budget")) & (F.col("after") - F.col("size") < F.col("budget")))
    level = F.when(F.col("min_e") < F.col("max_e"), 0).when(F.col("min_tie") < F.col("max_tie"), 1).otherwise(2)
    at = at.withColumn("level", level).withColumn("before", F.col("after") - F.col("size"))
    ends = [F.when(F.col("level") >= i, F.col(f"{side}_{k}")).otherwise(open_end).alias(f"{side}_{k}")
            for i, k in enumerate(KEYS) for side, open_end in (("min", F.lit(LOWEST)), ("max", F.lit(HIGHEST)))]
    return at.select("of", "budget", "before", "n", "level", *ends)


def _classes(rows: DataFrame, *by) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("size").alias("size"), F.count("*").alias("n"),
                                 *[f(k).alias(f"{side}_{k}") for k in KEYS for f, side in ((F.min, "min"), (F.max, "max"))])


def _inside(rows: DataFrame, cuts: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the cut of their source, ``cut`` (the row is in its class) and ``below`` (it comes before it)."""
    small = cuts.count() <= BROADCAST_ROWS
    both = rows.join(F.broadcast(cuts) if small else cuts, rows["source"].eqNullSafe(cuts["of"]), how)
    key, low, high = (F.struct(*[F.col(f"{side}{k}").alias(k) for k in KEYS]) for side in ("", "min_", "max_"))
    return both.withColumn("cut", (key >= low) & (key <= high)).withColumn("below", key < low)


def plan(rows: DataFrame, max_epochs: int, buckets: int, cut_rows: int) -> DataFrame:
    """One row per source: ``of``, target, complete epochs, the budget left, and the class in which it ends, if any."""
    sums = stored(_classes(rows.withColumn("class", F.least(F.floor(-F.expm1(-F.col("e")) * buckets), F.lit(buckets - 1)).cast("int")), "source", "class"), "mix-sums")
    aims = targets(sums.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aims = aims.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    aims = stored(aims.withColumnRenamed("source", "of"), "mix-aims")
    first = sums.join(aims.select("of", "budget"), sums["source"].eqNullSafe(aims["of"])).withColumn("before", F.lit(0).cast("long"))
    cuts = stored(_ends_in(first), "mix-cuts")
    low, high, value = (F.element_at(F.array(*[f"{side}{k}" for k in KEYS]), F.col("level") + 1) for side in ("min_", "max_", ""))
    large = (F.col("n") > cut_rows) & (low < high)
    while not cuts.where(large).isEmpty():
        part = F.least(F.floor((value - low) / (high - low) * buckets), F.lit(buckets - 1)).cast("int")
        again = _inside(rows, cuts.where(large)).where("cut").withColumn("class", part).select("of", "budget", "before", "class", "size", *KEYS)
        cuts = stored(cuts.where(~large).unionByName(_ends_in(_classes(again, "of", "budget", "before", "class"))), "mix-cuts")
    ends = cuts.drop("budget", "n", "level").withColumnRenamed("of", "at")
    return aims.join(ends, aims["of"].eqNullSafe(ends["at"]), "left").drop("at")


def mix(docs: DataFrame, quality: str | None = None, key: str = "doc_id", text: str = "text", source: str = "source",
        size: str | None = None, max_epochs: int = MAX_EPOCHS, buckets: int = BUCKETS, seed: str = SEED,
        cut_rows: int = CUT_ROWS, spread: str | None = None) -> DataFrame:
    """``docs`` in a struct ``_row``, then ``size``, ``source_size``, ``target`` and ``taken``.  ``quality`` names a
    column of document quality weights (none: all equal), ``size`` one of sizes (none: the words of ``text``),
    ``spread`` one of stored numbers that tell equal rows apart (none: equal rows are ordered in one task)."""
    q = F.col(f"`{quality}`").cast("double") if quality else F.lit(1.0)
    own, words = F.col(f"`{key}`"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{source}`").cast("string").alias("source"),
                       (F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)) if size else word_count(F.col(f"`{text}`"))).cast("long").alias("size"),
                       exponential_key(F.coalesce(own.cast("string"), F.concat(F.lit("text "), words)), q, seed).alias("e"), words.alias("words"),
                       own.alias("id"), (F.col(f"`{spread}`").cast("double") if spread else F.lit(0.0)).alias("spread"))
    rows = rows.withColumn("tie", F.xxhash64("id", "size", "words").cast("double")).drop("id", "words")
    aims = stored(plan(rows.select("source", "size", *KEYS), max_epochs, buckets, cut_rows), "mix-plan")
    both = _inside(rows, aims)
    order = Window.partitionBy("source").orderBy(*KEYS, "size").rowsBetween(Window.unboundedPreceding, -1)
    in_cut = F.coalesce("cut", F.lit(False))
    before = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    ended = both.where(in_cut).withColumn("chosen", 2 * before + F.col("size") < 2 * F.col("budget"))
    rest = both.where(~in_cut).withColumn("chosen", F.coalesce("below", F.lit(False)))
    taken = F.col("epochs") * F.col("size") + F.when(F.col("chosen"), F.col("size")).otherwise(0)
    return rest.unionByName(ended).select("_row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def quality_weights(labels: DataFrame) -> DataFrame:
    """(label_id, quality_weight): 0.5 for documents labelled 0 to 2 for those labelled 1, by the mean of repeated labels."""
    return (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
            .agg((F.lit(0.5) + 1.5 * F.avg("quality")).alias("quality_weight")))


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of ``documents``, weighted by the quality in ``labels``.  Sizes are
    counted before the labels are joined, so no text is shuffled."""
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("n_words"), F.md5("text").alias("text_hash"))
    weighted = stored(sizes.join(quality_weights(labels), F.col("doc_id") == F.col("label_id"), "left").drop("label_id")
                      .withColumn("nth", F.xxhash64(F.monotonically_increasing_id())), "mix-sizes")
    out = mix(weighted, quality="quality_weight", size="n_words", text="text_hash", spread="nth")
    return out.select("_row.doc_id", "_row.source", "size", "source_size", "target", "taken")


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("source")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size FROM documents),
q AS (SELECT doc_id, 0.5 + 1.5 * avg(quality) AS w FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.*, -ln((('0x' || substr(md5('{SEED}:' || d.doc_id), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / coalesce(w, 1.0) AS e
  FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
sw AS (SELECT source, source_size, 3 * source_size AS cap, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM sw
  WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN cap / w <= level THEN cap ELSE w * max(CASE WHEN cap / w > level THEN level END) OVER () END AS target FROM l),
b AS (SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
  coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY e, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  (epochs * size + CASE WHEN 2 * before + size < 2 * (target - epochs * source_size) THEN size ELSE 0 END)::BIGINT AS taken FROM b
"""
