"""Column-level building blocks: type families, missing values, text, casts."""

from kintsugi.functions.nulls import is_missing, nullify_nan
from kintsugi.functions.text import strip, is_padded, camel_to_snake
from kintsugi.functions.types import (dtype_name, dtype_matches, family, resolve_alias,
                                      spark_type_for)

__all__ = ["is_missing", "nullify_nan", "strip", "is_padded", "camel_to_snake",
           "dtype_name", "dtype_matches", "family", "resolve_alias", "spark_type_for"]
