"""Ordered (row-position) work on keyed series, without one task per series.

A pandas frame carries time in its row order; here order is always named:
``(key..., ts)``.  Row-based frames (``rolling(n)``, ``shift(k)``) are
evaluated one of two ways:

* plain: ``Window.partitionBy(key).orderBy(ts)`` -- one task per series.
  Fine when each series is bounded (e.g. an hourly table: at most one row per
  hour of the span).
* bucket + halo (default): a dense row index ``i`` per series is computed
  without a per-series task (row counts per coarse time bucket -> prefix sum
  over that small table -> ``row_number`` inside the bucket + offset).  Rows
  are cut into buckets of ``bucket_rows`` consecutive indexes; each row is
  also copied into the neighbouring bucket when it lies within the frame's
  reach of that bucket's rows.  The window then runs per ``(key, bucket)``
  and only each row's home copy is kept.  A hot series is thereby split into
  ``n / bucket_rows`` tasks, with results identical to the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

DEFAULT_BUCKET_ROWS = 100_000
_POS_BITS = 33  # monotonically_increasing_id: partition id above bit 33, position below


def _keys(key: str | Sequence[str] | None) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def _key_default(dt: DataType) -> Column:
    if isinstance(dt, StringType):
        return F.lit("")
    if isinstance(dt, NumericType):
        return F.lit(0).cast(dt)
    if isinstance(dt, BooleanType):
        return F.lit(False)
    if isinstance(dt, DateType):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(None).cast(dt)


def _norm_keys(df: DataFrame, keys: Sequence[str], prefix: str = "__k") -> tuple[DataFrame, list[str]]:
    """Non-NULL stand-ins for possibly-NULL key columns (value with NULL replaced, plus a NULL indicator).

    Joining and partitioning on these plain columns keeps NULL keys (a
    null-safe join would do that too, but hash-partitions on rewritten
    expressions, so a following window on the same keys would shuffle again).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols: dict[str, Column] = {}
    for i, k in enumerate(keys):
        dt = types[k]
        if isinstance(dt, (StringType, NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
            cols[f"{prefix}{i}v"] = F.coalesce(F.col(k), _key_default(dt))
        else:
            cols[f"{prefix}{i}v"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        cols[f"{prefix}{i}n"] = F.col(k).isNull()
    return df.withColumns(cols), list(cols)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], *, plain: Sequence[str] = (), how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Join on the keys ``on`` treating NULL = NULL, via plain equality on normalised key columns, and on the columns
    ``plain`` (times, say), whose NULLs match nothing.

    ``broadcast_right`` only where the caller has a proven small bound on ``right``.
    """
    l2, names = _norm_keys(left, on)
    r2, _ = _norm_keys(right, on)
    r2 = r2.drop(*on)
    if broadcast_right:
        r2 = F.broadcast(r2)
    return l2.join(r2, [*names, *plain], how).drop(*names)


_null_safe_join = null_safe_join


def time_bucket(ts: str, bucket_days: int = 1) -> Column:
    """Coarse, monotone time bucket (days since epoch // bucket_days); tz-free for DATE/TIMESTAMP_NTZ."""
    day = F.datediff(F.to_date(F.col(ts)), F.lit("1970-01-01").cast("date"))
    return F.floor(day / F.lit(bucket_days)).cast("long")


def series_index(
    df: DataFrame,
    key: str | Sequence[str] | None,
    ts: str,
    *,
    tiebreak: Sequence[str] = (),
    index_col: str = "_i",
    count_col: str | None = None,
    bucket_days: int = 1,
) -> DataFrame:
    """Add a dense 0-based row index per series in ``(ts, *tiebreak)`` order.

    ``(ts, *tiebreak)`` must be unique within a series for a deterministic
    index.  ``count_col`` (optional) receives the series length.  The only
    per-series window runs on the small table of bucket counts; the big side
    is shuffled once, on (series, time bucket), and that shuffle serves both
    the offset join and the row_number window.
    """
    keys = _keys(key)
    normed, nk = _norm_keys(df, keys)
    # NULL times get the lowest bucket (they sort first, as in the window's ORDER BY).
    with_tb = normed.withColumn("_tb", F.coalesce(time_bucket(ts, bucket_days), F.lit(-(2**62))))
    part = [*nk, "_tb"]
    counts = with_tb.groupBy(*part).agg(F.count(F.lit(1)).alias("_bc"))
    wk = Window.partitionBy(*nk).orderBy("_tb")
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_bc").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_bc").over(Window.partitionBy(*nk)))
    joined = with_tb.join(offsets.drop("_bc"), part, "inner")
    wb = Window.partitionBy(*part).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
    return joined.withColumn(index_col, F.col("_off") + F.row_number().over(wb) - 1).drop("_off", *part)


def ordered_columns(
    df: DataFrame,
    key: str | Sequence[str] | None,
    ts: str,
    columns: dict[str, Callable[[WindowSpec], Column]],
    *,
    back: int,
    ahead: int,
    bucket_rows: int | None = DEFAULT_BUCKET_ROWS,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Add window columns over each series in time order.

    ``columns`` maps an output name to ``fn(w)`` where ``w`` is the partitioned
    and ordered WindowSpec; ``fn`` adds its own row frame / offset.  ``back`` and
    ``ahead`` are the largest number of rows any frame reaches behind / ahead.
    ``bucket_rows=None`` selects the plain per-series window.
    """
    keys = _keys(key)
    if bucket_rows is None:
        w = Window.partitionBy(*keys).orderBy(F.col(ts), *[F.col(c) for c in tiebreak])
        return df.withColumns({name: fn(w) for name, fn in columns.items()})
    if bucket_rows < max(back, ahead, 1):
        raise ValueError(f"bucket_rows={bucket_rows} must be >= the frame reach {max(back, ahead)}")
    B = F.lit(bucket_rows)
    idx = series_index(df, keys, ts, tiebreak=tiebreak, index_col="_i")
    i = F.col("_i")
    home = F.floor(i / B)
    copies = F.array_distinct(F.array(F.floor((i - ahead) / B), home, F.floor((i + back) / B)))
    exploded = idx.withColumn("_wb", F.explode(F.filter(copies, lambda c: c >= 0)))
    w = Window.partitionBy(*keys, "_wb").orderBy("_i")
    out = exploded.withColumns({name: fn(w) for name, fn in columns.items()})
    return out.filter(F.col("_wb") == F.floor(F.col("_i") / B)).drop("_wb", "_i")


def sorted_index(
    df: DataFrame,
    order: Sequence[str | Column],
    *,
    group: Sequence[str] = (),
    index_col: str = "_gi",
    count_col: str | None = None,
) -> DataFrame:
    """Dense 0-based index in ``order`` within each ``group`` (or globally), via one range-partitioned sort.

    No group is ever gathered into one task: the sort spreads a hot group over
    many partitions; per-partition row counts (a table of at most
    partitions x groups-per-partition rows) give the offsets.  ``order`` must be
    a total order (add a unique tie-breaker) for the index to be deterministic.

    The sorted rows are used twice (counts, then positions), and positions come
    from the physical partition, so the sorted frame is checkpointed to the
    shared checkpoint folder first: both uses read the same materialised rows,
    whatever the planner or a recomputation after a lost executor would do.
    """
    from ..session import materialized

    g = list(group)
    s = df.orderBy(*[F.col(c) for c in g], *[F.col(c) if isinstance(c, str) else c for c in order])
    s = materialized(s.withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    s = s.withColumn("_pid", F.shiftrightunsigned("_mid", _POS_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )
    stats = s.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_first"))
    wg = Window.partitionBy(*g).orderBy("_pid")
    stats = stats.withColumn("_off", F.coalesce(F.sum("_c").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if count_col:
        stats = stats.withColumn(count_col, F.sum("_c").over(Window.partitionBy(*g)))
    stats = stats.drop("_c")
    out = _null_safe_join(s, stats, ["_pid", *g])
    return out.withColumn(index_col, F.col("_off") + F.col("_pos") - F.col("_first")).drop("_mid", "_pid", "_pos", "_off", "_first")


# ---------------------------------------------------------------------------
# W1-W7 and the window features of the feature builders


def _mean_min_periods(value: str, w: WindowSpec, lo: int, hi: int, min_periods: int) -> Column:
    f = w.rowsBetween(lo, hi)
    return F.when(F.count(F.col(value)).over(f) >= min_periods, F.avg(F.col(value)).over(f))


TRAILING_SPECS = ((1, 1), (2, 2), (3, 1), (7, 1))  # (window rows, min_periods)
CENTERED_WIDTHS = (3, 7)


def trailing_means(
    df: DataFrame, key, ts: str, value: str = "Load", specs=TRAILING_SPECS, *, bucket_rows=DEFAULT_BUCKET_ROWS
) -> DataFrame:
    """``{value}Trailing{n}``: mean of the last n rows incl. the current one, NULL below min_periods."""
    cols = {f"{value}Trailing{n}": (lambda w, n=n, mp=mp: _mean_min_periods(value, w, -(n - 1), 0, mp)) for n, mp in specs}
    back = max(n for n, _ in specs) - 1
    return ordered_columns(df, key, ts, cols, back=back, ahead=0, bucket_rows=bucket_rows)


def centered_means(
    df: DataFrame, key, ts: str, value: str = "Load", widths=CENTERED_WIDTHS, min_periods: int = 1, *, bucket_rows=DEFAULT_BUCKET_ROWS
) -> DataFrame:
    """``{value}Centered{n}``: mean of n rows centred on the current one (n odd)."""
    for n in widths:
        if n % 2 == 0:
            raise ValueError("centered widths must be odd")
    cols = {
        f"{value}Centered{n}": (lambda w, n=n: _mean_min_periods(value, w, -(n // 2), n // 2, min_periods)) for n in widths
    }
    reach = max(widths) // 2
    return ordered_columns(df, key, ts, cols, back=reach, ahead=reach, bucket_rows=bucket_rows)


def rolling_features(df: DataFrame, key, ts: str, value: str = "Load", *, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """All six rolling means of the feature builder in one window pass."""
    cols = {f"{value}Trailing{n}": (lambda w, n=n, mp=mp: _mean_min_periods(value, w, -(n - 1), 0, mp)) for n, mp in TRAILING_SPECS}
    cols.update({f"{value}Centered{n}": (lambda w, n=n: _mean_min_periods(value, w, -(n // 2), n // 2, 1)) for n in CENTERED_WIDTHS})
    return ordered_columns(df, key, ts, cols, back=6, ahead=3, bucket_rows=bucket_rows)


def rolling_pair(df: DataFrame, key, ts: str, value: str = "Load", window: int = 3, *, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``{value}Rolling{w}`` = centred mean of 2w+1 rows, ``{value}Trailing{w}`` = trailing mean of w rows."""
    cols = {
        f"{value}Rolling{window}": lambda w: _mean_min_periods(value, w, -window, window, 1),
        f"{value}Trailing{window}": lambda w: _mean_min_periods(value, w, -(window - 1), 0, 1),
    }
    return ordered_columns(df, key, ts, cols, back=window, ahead=window, bucket_rows=bucket_rows)


def lead_target(df: DataFrame, key, ts: str, value: str = "Load", horizon: int = 7, out: str | None = None,
                *, drop_tail: bool = True, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Target ``horizon`` rows ahead; rows without one (the tail) dropped unless ``drop_tail=False``."""
    out = out or f"{value}_target"
    res = ordered_columns(df, key, ts, {out: lambda w: F.lead(F.col(value), horizon).over(w)},
                          back=0, ahead=horizon, bucket_rows=bucket_rows)
    return res.filter(F.col(out).isNotNull()) if drop_tail else res


def calendar_lead(df: DataFrame, key, ts: str, value: str = "Load", hours: int = 7, out: str | None = None) -> DataFrame:
    """Value at exactly ``ts + hours`` of the same series (NULL when that hour is absent): a self equi-join."""
    keys = _keys(key)
    out = out or f"{value}_target"
    ahead = df.select(*keys, (F.col(ts) - F.make_interval(hours=F.lit(hours))).alias(ts), F.col(value).alias(out))
    return null_safe_join(df, ahead, keys, plain=[ts], how="left").select(*df.columns, out)


def lags(df: DataFrame, key, ts: str, value: str = "Load", lags: Sequence[int] = (24, 168), *, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``{value}Lag{k}``: value k rows earlier in the series."""
    cols = {f"{value}Lag{k}": (lambda w, k=k: F.lag(F.col(value), k).over(w)) for k in lags}
    return ordered_columns(df, key, ts, cols, back=max(lags), ahead=0, bucket_rows=bucket_rows)


def rolling_std(df: DataFrame, key, ts: str, value: str = "Load", n: int = 24, min_periods: int = 2, *, bucket_rows=DEFAULT_BUCKET_ROWS) -> DataFrame:
    """``{value}Std{n}``: sample standard deviation of the last n rows."""
    def fn(w):
        f = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count(F.col(value)).over(f) >= min_periods, F.stddev_samp(F.col(value)).over(f))
    return ordered_columns(df, key, ts, {f"{value}Std{n}": fn}, back=n - 1, ahead=0, bucket_rows=bucket_rows)


def daily_lag_table(df: DataFrame, key, date: str, value: str = "Load", days: int = 1, out: str | None = None,
                    *, mode: str = "present", bucket_rows: int | None = None) -> DataFrame:
    """(series, date, lagged daily mean): mean of ``value`` per (series, date), shifted by ``days``.

    mode="present": shift by ``days`` *present* dates (a missing date shifts
    further back, as a shifted daily series does).  mode="calendar": the
    mean of exactly ``date - days`` (NULL if that date is absent).
    The table has one row per series and date -- bounded by the days of the
    span, not by the raw rows -- so the plain window is the default.
    """
    keys = _keys(key)
    out = out or f"{days}DayLag"
    daily = df.groupBy(*keys, date).agg(F.avg(F.col(value)).alias("_dm"))
    if mode == "present":
        return ordered_columns(daily, keys, date, {out: lambda w: F.lag("_dm", days).over(w)},
                               back=days, ahead=0, bucket_rows=bucket_rows).drop("_dm")
    if mode == "calendar":
        return daily.select(*keys, F.date_add(F.col(date), days).alias(date), F.col("_dm").alias(out))
    raise ValueError("mode must be 'present' or 'calendar'")


def daily_lag_mean(df: DataFrame, key, date: str, value: str = "Load", days: int = 1, out: str | None = None,
                   *, mode: str = "present", bucket_rows=None) -> DataFrame:
    """Lagged daily mean mapped back onto every row of that date (left join on (series, date))."""
    keys = _keys(key)
    lagged = daily_lag_table(df, keys, date, value, days, out, mode=mode, bucket_rows=bucket_rows)
    return null_safe_join(df, lagged, keys, plain=[date], how="left")


def chrono_split(df: DataFrame, key, ts: str, train_fraction: float = 0.8, out: str = "is_test",
                 *, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First floor(n * train_fraction) rows of each series are train, the rest test (``out`` = true)."""
    idx = series_index(df, key, ts, tiebreak=tiebreak, index_col="_i", count_col="_n")
    cut = F.floor(F.col("_n") * F.lit(train_fraction))
    return idx.withColumn(out, F.col("_i") >= cut).drop("_i", "_n")


def position_slice(df: DataFrame, key, ts: str, start: int, stop: int, *, tiebreak: Sequence[str] = (),
                   index_col: str | None = None) -> DataFrame:
    """Rows at 0-based positions [start, stop) of each series (``values[start:stop]``)."""
    idx = series_index(df, key, ts, tiebreak=tiebreak, index_col="_i")
    res = idx.filter((F.col("_i") >= start) & (F.col("_i") < stop))
    return res.withColumnRenamed("_i", index_col) if index_col else res.drop("_i")
