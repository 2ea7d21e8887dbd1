"""Profiling and grouped summaries (A1-A16).  Results are small tables; no value reaches the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, NumericType, StringType, StructType

from .clean import flag_columns, numeric_columns
from .quantiles import column_quantiles

MASK_BITS = 60  # columns of one null mask
CORR_CHUNK = 120  # pairs of columns scored in one aggregate: 15 columns in a single read


def _q(c: str):
    return F.col(f"`{c}`")


def category_mean(df: DataFrame, category: str, y: str, out: str | None = None) -> DataFrame:
    """A1: mean of ``y`` per category (NULL categories dropped), ordered by category."""
    out = out or f"mean_{y}"
    return df.filter(_q(category).isNotNull()).groupBy(category).agg(F.avg(_q(y)).alias(out)).orderBy(category)


def onehot_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A2: per flag column, the number of 1s and of 0s: ``(column, n_yes, n_no)`` in one pass."""
    aggs = []
    for c in columns:
        aggs += [F.count_if(_q(c) == 1).alias(f"{c}__yes"), F.count_if(_q(c) == 0).alias(f"{c}__no")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__yes`, `{c}__no`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, n_yes, n_no)")


def cond_mean(df: DataFrame, flag: str, y: str) -> DataFrame:
    """A3: mean of ``y`` where ``flag`` = 1 and where it = 0, one pass."""
    return df.agg(
        F.avg(F.when(_q(flag) == 1, _q(y))).alias("yes_mean"),
        F.avg(F.when(_q(flag) == 0, _q(y))).alias("no_mean"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """A4: ``(column, n_missing, pct_missing)`` for every column (NaN counts as missing)."""
    cols = df.columns
    def miss(c):
        f = next(x for x in df.schema.fields if x.name == c)
        isnan = F.isnan(_q(c)) if isinstance(f.dataType, NumericType) else F.lit(False)
        return F.count_if(_q(c).isNull() | isnan)
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[miss(c).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__n", f"stack({len(cols)}, {stack}) AS (column, n_missing)")
    return long.select("column", "n_missing", (F.col("n_missing") * 100.0 / F.col("__n")).alias("pct_missing"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """A5: count, mean, std, min, 25/50/75 %, max per numeric column (exact quantiles by default)."""
    cols = list(columns or numeric_columns(df))
    extra = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], approx=approx, extra=extra)
    # a column with no values at all still gets its row (count 0)
    allc = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = allc.join(qs, "column", "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("long")))
    return out.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _as_text(df: DataFrame, c: str):
    """A column's values as text, different for different values."""
    t = df.schema[c].dataType
    if isinstance(t, (FloatType, DoubleType)):
        return (_q(c) + F.lit(0).cast(t)).cast("string")  # -0.0 is 0.0
    if isinstance(t, BinaryType):
        return F.hex(_q(c))
    return F.to_json(_q(c)) if isinstance(t, (ArrayType, MapType, StructType)) else _q(c).cast("string")


def value_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, freq)`` of every non-NULL value, as text: one aggregate over (column, value) for all columns,
    combined before its shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _as_text(df, c).alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.*")
    return long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))


def top_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values and most frequent non-NULL value per column with its frequency; ties -> smallest value.

    ``(column, unique, top, freq)`` from the value table, by partial minima: no column's values are sorted."""
    first = F.min(F.struct((-F.col("freq")).alias("f"), "value"))
    out = value_table(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("unique"), first.alias("t"))
    return out.select("column", "unique", F.col("t.value").alias("top"), (-F.col("t.f")).alias("freq"))


def describe_all(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """One row per column: count, unique/top/freq for text columns, numeric summary for numeric ones."""
    num = numeric_columns(df)
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    counts = df.agg(*[F.count(_q(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "count")
    parts = [counts]
    if txt:
        parts.append(top_values(df, txt))
    if num:
        parts.append(describe(df, num, approx=approx).drop("count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "column", "left")
    if txt:  # a text column without a value
        out = out.withColumn("unique", F.coalesce("unique", F.when(F.col("column").isin(txt), F.lit(0))))
    order = ["column", "count"] + (["unique", "top", "freq"] if txt else []) + (
        ["mean", "std", "min", "q25", "q50", "q75", "max"] if num else [])
    return out.select(*order)


def nunique(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """``(column, nunique)``, missing values excluded.

    Exact counts are the rows of the value table (no row is copied per column before a shuffle: a column's values are
    combined in the tasks first); approximate ones are sketches of fixed size."""
    cols = list(columns or df.columns)
    if approx:
        return estimates(sketches(df, cols))
    seen = value_table(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("nunique"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return every.join(seen, "column", "left").select("column", F.coalesce("nunique", F.lit(0).cast("long")).alias("nunique"))


def sketches(df: DataFrame, columns: Sequence[str] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """``(group, column, sketch)``: a HyperLogLog sketch of each column's values (per group, a month say), mergeable later."""
    cols = [c for c in columns or df.columns if c not in group]
    wide = df.groupBy(*group).agg(*[F.hll_sketch_agg(_as_text(df, c)).alias(f"s{i}") for i, c in enumerate(cols)])
    recs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return wide.select(*group, F.explode(recs).alias("r")).select(*group, "r.*")


def estimates(made: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``(group, column, nunique)`` of stored sketches, merged over everything but ``group`` and column."""
    return made.groupBy(*group, "column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("nunique"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per value including NULL, most frequent first (ties by value)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc_nulls_first(column))


def moments(df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False) -> DataFrame:
    """``(column, mean, std, median)`` of numeric columns; mean and std are one plain aggregate."""
    cols = list(columns or numeric_columns(df))
    wide = df.agg(*[fn(_q(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols) for n, fn in (("m", F.avg), ("s", F.stddev_samp))])
    recs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)])
    plain = wide.select(F.explode(recs).alias("r")).select("r.*")
    med = column_quantiles(df, cols, [0.5], ["median"], approx=approx)
    return plain.join(med, "column", "left").select("column", "mean", "std", "median")


def safe_corr(a, b):
    """Pearson correlation over pairwise-complete rows; NULL (not an error) for a constant column or one row."""
    a_ok = F.when(b.isNotNull(), a)
    b_ok = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a_ok) * F.stddev_samp(b_ok))


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(x, y, r)`` for every ordered pair of numeric columns, pairwise-complete; NULL (not an error) for a column
    that is constant over a pair's rows.

    One read: rows are grouped by which of their values are missing (a bit mask), and each group has plain sums of
    every column, its square and the products of pairs, of values shifted by one of the column's own (so large values
    lose no digits).  A pair's figures are those of the groups in which both are present, added up in the small table of
    groups.  Beyond ``CORR_CHUNK`` pairs the read is repeated for the next chunk of pairs, so a row of sums stays small."""
    cols = list(columns or numeric_columns(df))
    wide = df.select(*[_q(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    some = wide.limit(1000).selectExpr(*[f"first(c{i}, true) AS c{i}" for i in range(len(cols))]).first()
    shift = [v if v is not None and math.isfinite(v) else 0.0 for v in some]
    moved = wide.selectExpr(*[f"c{i} - CAST('{v!r}' AS DOUBLE) AS c{i}" for i, v in enumerate(shift)])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "_i int, _name string")
    parts = []
    for k in range(0, len(pairs), CORR_CHUNK):
        own = pairs[k:k + CORR_CHUNK]
        used = sorted({i for p in own for i in p})
        words = range(0, len(used), MASK_BITS)
        masks = [" | ".join(f"if(c{i} IS NULL, 0L, {1 << b}L)" for b, i in enumerate(used[m:m + MASK_BITS])) + f" AS m{m}" for m in words]
        keys = [f"m{m}" for m in words]
        array = {c: f"array({', '.join(f'{f}(c{i})' for i in used)}) AS {c}" for c, f in (("s", "sum"), ("lo", "min"), ("hi", "max"))}
        array |= {"q": f"array({', '.join(f'sum(c{i} * c{i})' for i in used)}) AS q", "p": f"array({', '.join(f'sum(c{i} * c{j})' for i, j in own)}) AS p"}
        sums = moved.selectExpr("*", *masks).groupBy(*keys).agg(F.expr("count(1) AS n"), *[F.expr(x) for x in array.values()])
        # groups x ordered pairs, from arrays of the sums; a group of no rows keeps the pairs of an empty table
        none = df.sparkSession.range(1).selectExpr(*[f"0L AS {m}" for m in keys], "0L AS n")
        at = {i: b for b, i in enumerate(used)}
        every = ", ".join(f"struct({i} AS x, {j} AS y, {at[i]} AS i, {at[j]} AS j, {t} AS t)" for t, p in enumerate(own) for i, j in sorted({p, p[::-1]}))
        of = sums.unionByName(none, allowMissingColumns=True).selectExpr(f"array({', '.join(keys)}) AS m", "n", "s", "q", "lo", "hi", "p", f"explode(array({every})) AS e")
        both = " AND ".join(f"getbit(get(m, CAST(e.{v} DIV {MASK_BITS} AS INT)), e.{v} % {MASK_BITS}) = 1" for v in "ij")
        fields = {"n": "n", "p": "get(p, e.t)"} | {f"{c}{v}": f"get({c}, e.{i})" for c in ("s", "q", "lo", "hi") for v, i in (("x", "i"), ("y", "j"))}
        each = of.selectExpr("e.x", "e.y", *[f"CASE WHEN {both} THEN {v} END AS {c}" for c, v in fields.items()])
        g = each.groupBy("x", "y").agg(*[F.expr(f"{'min' if c[:2] == 'lo' else 'max' if c[:2] == 'hi' else 'sum'}({c}) AS {c}") for c in fields])
        spread = " * ".join(f"sqrt(greatest(q{v} - s{v} * s{v} / n, 0D))" for v in "xy")
        parts.append(g.selectExpr("x AS _x", "y AS _y", f"CASE WHEN lox < hix AND loy < hiy THEN try_divide(p - sx * sy / n, {spread}) END AS r"))
    out = reduce(DataFrame.unionByName, parts)
    for v in "xy":
        out = out.join(F.broadcast(names.withColumnRenamed("_name", v)), F.col(f"_{v}") == F.col("_i")).drop("_i")  # one row a column
    return out.select("x", "y", "r")


def time_span(df: DataFrame, ts: str, group: Sequence[str] = ()) -> DataFrame:
    """First and last time (per group)."""
    return df.groupBy(*group).agg(F.min(_q(ts)).alias("first"), F.max(_q(ts)).alias("last"))


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_cols)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def schema_table(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)`` -- names and types from the schema, counts in one pass."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(_q(f.name)).alias(f"n{i}") for i, f in enumerate(fields)])
    stack = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', n{i}" for i, f in enumerate(fields))
    return wide.selectExpr(f"stack({len(fields)}, {stack}) AS (position, column, type, non_null)")


def scale_by_count(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Each value divided by the table's row count (NULL rows counted), via a scalar subquery."""
    n = df.select(F.count(F.lit(1))).scalar()
    return df.withColumn(out or f"{column}_scaled", _q(column) / n)


def check_relevance(df: DataFrame, column: str, y: str | None, kind: str) -> DataFrame:
    """the report named by ``kind``: the table behind each chart or printout of the exploration script.

    ``categoryAverage``: mean of ``y`` per value of ``column``; ``oneHot``: numbers of 1s and 0s; ``oneHotAvg``: means
    of ``y`` where the flag is 1 and where it is 0; ``scatterPlot``: the (column, y) points with both values present.
    """
    if kind == "categoryAverage":
        return category_mean(df, column, y)
    if kind == "oneHot":
        return flag_columns(df.select(_q(column)), column).agg(F.count_if("Yes").alias("n_yes"), F.count_if("No").alias("n_no"))
    if kind == "oneHotAvg":
        return cond_mean(df, column, y)
    if kind == "scatterPlot":
        return df.select(_q(column), _q(y)).dropna()
    raise ValueError(f"no such report: {kind}")
