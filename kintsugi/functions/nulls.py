"""One notion of "missing": NULL, and NaN for floating columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from kintsugi.functions.types import is_float


def is_missing(col: str | Column, dt: T.DataType) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if is_float(dt):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nullify_nan(col: str | Column, dt: T.DataType) -> Column:
    """NaN becomes NULL so aggregates and coalesce treat both alike."""
    c = F.col(col) if isinstance(col, str) else col
    if is_float(dt):
        return F.when(F.isnan(c), F.lit(None).cast(dt)).otherwise(c)
    return c


def missing_count(df, column: str) -> Column:
    return F.count_if(is_missing(column, df.schema[column].dataType))
