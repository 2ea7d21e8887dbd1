"""Projections, filters and simple column operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows where ``column == value`` (pushed to the Parquet scan)."""
    return df.filter(F.col(column) == F.lit(value))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def drop_and_rename(df: DataFrame, drop: Iterable[str] = (), rename: dict[str, str] | None = None) -> DataFrame:
    """Drop columns, then rename (a rename of an absent column is a no-op, as in pandas)."""
    out = df.drop(*drop)
    present = {k: v for k, v in (rename or {}).items() if k in out.columns}
    return out.withColumnsRenamed(present) if present else out


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric columns, in schema order, minus ``exclude``."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in numeric_columns(df, exclude)])


def filter_as_of(df: DataFrame, date_col: str, as_of) -> DataFrame:
    """Rows with ``date_col <= as_of`` (inclusive)."""
    return df.filter(F.col(date_col) <= F.lit(as_of).cast("date"))


def threshold_flags(df: DataFrame, column: str = "Temperature", hot: float = 20.0, cold: float = 9.0,
                    hot_col: str = "hotFlag", cold_col: str = "coldFlag") -> DataFrame:
    """hot = column > hot, cold = column < cold (strict); a missing value gives 0 and 0."""
    c = F.col(column)
    return df.withColumns({
        hot_col: F.coalesce((c > F.lit(hot)).cast("int"), F.lit(0)),
        cold_col: F.coalesce((c < F.lit(cold)).cast("int"), F.lit(0)),
    })


def mask_where(df: DataFrame, columns: Sequence[str], condition: Column | str) -> DataFrame:
    """P10: blank (NULL) ``columns`` on rows where ``condition`` holds, e.g. a look-ahead feature in the test part."""
    cond = F.col(condition) if isinstance(condition, str) else condition
    return df.withColumns({c: F.when(cond, F.lit(None)).otherwise(F.col(c)) for c in columns})


def cast_columns(df: DataFrame, casts: dict[str, str], *, safe: bool = False) -> DataFrame:
    """Cast columns; ``safe=True`` gives NULL for values that do not convert (ANSI raises otherwise)."""
    fn = (lambda c, t: F.col(c).try_cast(t)) if safe else (lambda c, t: F.col(c).cast(t))
    return df.withColumns({c: fn(c, t) for c, t in casts.items()})


def flag_columns(df: DataFrame, column: str, yes: str = "Yes", no: str = "No") -> DataFrame:
    """Boolean ``Yes`` = (column == 1), ``No`` = (column == 0)."""
    return df.withColumns({yes: F.col(column) == 1, no: F.col(column) == 0})
