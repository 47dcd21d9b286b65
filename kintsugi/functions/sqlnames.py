"""The library's rules as SQL functions, so that checks and rubrics can be written in SQL alone.

``register`` defines session functions with SQL bodies: Spark inlines them, so they are
optimised, pushed down and pruned like the expressions themselves, also inside temporary
views.  They give what the column functions of the same name give:

* ``py_strip(text)``: ``text.strip``;
* ``is_padded(text)``: ``text.is_padded``;
* ``is_missing(number)``: NULL or NaN, for doubles (other columns: ``IS NULL``);
* ``row_credit(rows, expected, tolerance)``: ``score.row_credit``;
* ``clamp01(x)``: ``score.clamp01``;
* ``flag(condition)``: ``score.flag``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from kintsugi.functions.text import _STRIP_RE


def definitions() -> dict[str, str]:
    """Signature and body of each function."""
    pattern = _STRIP_RE.encode("unicode_escape").decode().replace("'", "\\'")
    return {
        "py_strip(value STRING)": f"STRING RETURN regexp_replace(value, '{pattern}', '')",
        "is_padded(value STRING)": f"BOOLEAN RETURN value <> regexp_replace(value, '{pattern}', '')",
        "is_missing(value DOUBLE)": "BOOLEAN RETURN value IS NULL OR isnan(value)",
        "clamp01(x DOUBLE)": "DOUBLE RETURN greatest(0D, least(1D, x))",
        "flag(condition BOOLEAN)": "DOUBLE RETURN CASE WHEN coalesce(condition, false) THEN 1D ELSE 0D END",
        "row_credit(actual DOUBLE, expected DOUBLE, tolerance DOUBLE)":
            "DOUBLE RETURN CASE WHEN abs(actual - expected) <= tolerance THEN 1D "
            "ELSE greatest(0D, 1D - abs(CASE WHEN expected <> 0 THEN actual / expected ELSE 0D END - 1D)) END",
    }


def register(spark: SparkSession) -> list[str]:
    """Defines the functions in the session; returns their names."""
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {body}")
    return [s.split("(")[0] for s in definitions()]
