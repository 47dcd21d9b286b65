"""Text helpers that run as JVM expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Python's str.strip() removes every character for which isspace() holds.
# Java's \s covers only ASCII whitespace, so the Unicode separators and the
# remaining isspace() control characters are listed as well.
_WS = r"[\s\p{Z}\x1c-\x1f\x85]"
_STRIP_RE = rf"^{_WS}+|{_WS}+$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: str | Column) -> Column:
    """Remove leading and trailing whitespace the way Python's strip does."""
    return F.regexp_replace(_c(col), _STRIP_RE, "")


def is_padded(col: str | Column) -> Column:
    c = _c(col)
    return c != strip(c)


def camel_to_snake(name: str) -> str:
    """Column-name rewrite (metadata only, runs on the driver)."""
    s = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s).lower()
