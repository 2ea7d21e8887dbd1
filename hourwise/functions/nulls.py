"""Missing-value normalisation.

pandas treats NaN as missing; Spark does not (``NaN > 20`` is true and ``avg``
turns NaN).  Every source therefore maps NaN to NULL once, at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating-point column; other columns untouched."""
    fixes = {
        f.name: nan_to_null(F.col(f"`{f.name}`")).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, (DoubleType, FloatType))
    }
    return df.withColumns(fixes) if fixes else df
