"""Type names, type families and the contract's equivalence rule.

Contracts are written with pandas-style dtype names (``int64``, ``float64``,
``object`` ...).  Spark schemas are mapped onto those names so a contract
can be checked against ``df.schema`` on the driver, without running a job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The cast aliases a contract or a cast request may use, and
# the stored dtype each one means.
DTYPE_ALIASES = {
    "int": "int64",
    "int64": "int64",
    "int32": "int32",
    "float": "float64",
    "float64": "float64",
    "str": "object",
    "string": "object",
    "object": "object",
    "bool": "bool",
    "datetime": "datetime64[ns]",
}

# The dtype names that satisfy a name a contract may ask for;
# any other name is satisfied by itself only.
_WHOLE = frozenset({"int64", "int32", "int16", "int8", "int"})
_REAL = frozenset({"float64", "float32", "float"})
_TEXT = frozenset({"object", "string", "str"})
SATISFIED_BY = {"int": _WHOLE, "int64": _WHOLE, "float": _REAL, "float64": _REAL,
                "object": _TEXT, "string": _TEXT, "str": _TEXT}

_SPARK_FOR_DTYPE = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "object": T.StringType(),
    "bool": T.BooleanType(),
    "datetime64[ns]": T.TimestampType(),
}


def resolve_alias(name: str) -> str:
    """Map a cast alias to its stored dtype name; unknown names pass through."""
    return DTYPE_ALIASES.get(name, name)


def spark_type_for(name: str) -> T.DataType:
    stored = resolve_alias(name)
    try:
        return _SPARK_FOR_DTYPE[stored]
    except KeyError:
        raise ValueError(f"unsupported target type {name!r}") from None


def dtype_name(dt: T.DataType) -> str:
    """pandas-style dtype name for a Spark type."""
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, T.ShortType):
        return "int16"
    if isinstance(dt, T.ByteType):
        return "int8"
    if isinstance(dt, T.DoubleType):
        return "float64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "object"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    if isinstance(dt, T.DateType):
        return "date"
    return dt.simpleString()


def dtype_matches(actual: str, expected: str) -> bool:
    """One-way equivalence: does a column of ``actual`` satisfy ``expected``?"""
    wanted = expected.lower()
    return actual.lower() in SATISFIED_BY.get(wanted, {wanted})


def family(dt: T.DataType) -> str:
    """Coarse family used by comparison and join guards."""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                       T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    return "other"


def value_family(v) -> str:
    """Family of a Python literal (bool before int: bool is an int subclass)."""
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "text"
    import datetime as _dt
    if isinstance(v, (_dt.date, _dt.datetime)):
        return "time"
    return "other"


def is_float(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def field_type(df, column: str) -> T.DataType:
    try:
        return df.schema[column].dataType
    except KeyError:
        raise KeyError(f"column {column!r} not found; columns: {df.columns}") from None
