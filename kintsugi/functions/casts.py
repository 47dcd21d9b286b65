"""Cast expressions with the conversion rules of the repair contract.

* integer targets are strict: a value that is missing, unparsable or
  fractional has no integer form, and the cast of the whole column fails;
* ``float64`` coerces: unparsable text becomes NULL;
* ``object`` keeps NULL as NULL (``null_text=True`` prints ``None``/``nan``
  the way pandas ``astype(str)`` does);
* ``bool`` follows Python truthiness when ``truthy=True``;
* ``datetime`` tries a list of formats and gives NULL when none fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from kintsugi.functions.nulls import is_missing
from kintsugi.functions.text import strip
from kintsugi.functions.types import family, field_type, is_float, resolve_alias, spark_type_for

# The text layouts tried, in order, when text becomes a timestamp.
DEFAULT_TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)

# The text layouts that ``time_format_counts`` tells apart, in order of preference.
KNOWN_TIME_FORMATS = DEFAULT_TIME_FORMATS + (
    "yyyy/MM/dd",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "dd.MM.yyyy",
    "dd-MM-yyyy",
    "yyyyMMdd",
)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _integral_double(d: Column) -> Column:
    """A double's integer form: whole, and within the range of 64-bit integers."""
    edge = F.lit(float(1 << 63))
    return F.when((d >= -edge) & (d < edge) & (F.rint(d) == d), d.cast("bigint"))


def to_int(col: str | Column, dt: T.DataType, target: T.DataType = T.LongType(),
           stripped: bool = False) -> Column:
    """Integer form of a value or NULL when it has none (never raises)."""
    c = _c(col)
    fam = family(dt)
    if fam == "text":
        s = c if stripped else strip(c)
        # parse as bigint only text that looks like an integer: a failing
        # try_cast to bigint is an order of magnitude slower than this test
        as_long = F.when(s.rlike(r"^[+-]?[0-9]{1,19}$"), s.try_cast("bigint"))
        as_double = s.try_cast("double")
        out = F.coalesce(as_long, _integral_double(as_double))
    elif is_float(dt):
        out = _integral_double(c.cast("double"))
    elif isinstance(dt, T.DecimalType):
        out = F.when(c == F.floor(c), c.try_cast("bigint"))
    elif fam in ("number", "bool"):
        out = c.cast("bigint")
    else:
        out = c.try_cast("bigint")
    if not isinstance(target, T.LongType):
        out = out.try_cast(target)
    return out


def to_double(col: str | Column, dt: T.DataType, stripped: bool = False) -> Column:
    c = _c(col)
    fam = family(dt)
    if fam == "text":
        return (c if stripped else strip(c)).try_cast("double")
    if fam in ("number", "bool"):
        return c.cast("double")
    if fam == "time":
        return (F.unix_micros(c.cast("timestamp")) * F.lit(1000)).cast("double")
    return c.try_cast("double")


def to_text(col: str | Column, dt: T.DataType, null_text: bool = False) -> Column:
    c = _c(col)
    out = c.cast("string")
    if null_text:
        word = "nan" if is_float(dt) else "None"
        out = F.when(is_missing(c, dt), F.lit(word)).otherwise(out)
    return out


def to_bool(col: str | Column, dt: T.DataType, truthy: bool = True) -> Column:
    c = _c(col)
    fam = family(dt)
    if not truthy:
        return c.try_cast("boolean")
    if fam == "text":
        return F.when(c.isNull(), F.lit(False)).otherwise(F.length(c) > 0)
    if is_float(dt):
        return F.when(c.isNull(), F.lit(False)).when(F.isnan(c), F.lit(True)).otherwise(c != 0)
    if fam == "number":
        return F.when(c.isNull(), F.lit(False)).otherwise(c != 0)
    if fam == "bool":
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def to_timestamp(col: str | Column, dt: T.DataType,
                 formats: tuple[str, ...] = DEFAULT_TIME_FORMATS, stripped: bool = False) -> Column:
    c = _c(col)
    fam = family(dt)
    if fam == "text":
        s = c if stripped else strip(c)
        return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])
    if fam == "time":
        return c.cast("timestamp")
    if fam == "number" and isinstance(dt, T.IntegralType):
        # integers are read as epoch nanoseconds, exactly
        ns = c.cast("bigint")
        return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))
    if fam == "number":
        return F.timestamp_micros(F.floor(c.cast("double") / 1000).cast("bigint"))
    return c.try_cast("timestamp")


def cast_expr(col: str, dt: T.DataType, target: str, *, null_text: bool = False,
              truthy: bool = True, formats: tuple[str, ...] = DEFAULT_TIME_FORMATS,
              stripped_col: str | None = None) -> tuple[Column, bool]:
    """Return ``(expression, strict)`` for casting ``col`` to ``target``.

    ``strict`` tells whether a NULL result for a present value means the
    whole cast must fail (integer targets).  ``stripped_col`` names a column
    that already holds the stripped text of ``col`` (computed once).
    """
    stored = resolve_alias(target)
    src, pre = (stripped_col, True) if stripped_col else (col, False)
    if stored in ("int64", "int32", "int16", "int8"):
        return to_int(src, dt, spark_type_for(stored), stripped=pre), True
    if stored in ("float64", "float32"):
        out = to_double(src, dt, stripped=pre)
        if stored == "float32":
            out = out.cast("float")
        return out, False
    if stored == "object":
        return to_text(col, dt, null_text=null_text), False
    if stored == "bool":
        return to_bool(col, dt, truthy=truthy), False
    if stored == "datetime64[ns]":
        return to_timestamp(src, dt, formats, stripped=pre), False
    raise ValueError(f"unsupported target type {target!r}")


def time_format_counts(df: DataFrame, column: str, formats: tuple[str, ...] = KNOWN_TIME_FORMATS) -> DataFrame:
    """``(position, time_format, parsed, present)`` per candidate layout: how many of the present
    (not NULL, not blank) texts it reads.  One aggregate over the column; no value leaves its task."""
    if family(field_type(df, column)) != "text":
        raise ValueError(f"column {column!r} is no text")
    texts = df.select(strip(column).alias("s")).where("s <> ''")
    counts = texts.agg(F.count(F.lit(1)).alias("present"), *[F.count(F.try_to_timestamp(F.col("s"), F.lit(f))).alias(f"__f{i}")
                                                            for i, f in enumerate(formats)])
    return counts.select("present", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("time_format"), F.col(f"__f{i}").alias("parsed"))
        for i, f in enumerate(formats)]))).select("position", "time_format", "parsed", "present")


def infer_time_formats(df: DataFrame, column: str, formats: tuple[str, ...] = KNOWN_TIME_FORMATS) -> tuple[str, ...]:
    """The layouts of a text column, for ``cast_expr(formats=...)``: those that read any value, most
    values first, the earlier candidate at a tie.  A day above 12 anywhere thus settles whether days or
    months come first; where nothing does, the candidates' order decides.  ``()`` where none reads any."""
    found = time_format_counts(df, column, formats).where("parsed > 0").orderBy(F.desc("parsed"), "position")
    return tuple(r.time_format for r in found.collect())  # at most one row per candidate
