"""Assemble the catalogue from the per-area query modules."""

from __future__ import annotations

from kintsugi.plans import registry
from kintsugi.plans import join_profile_queries, repair_queries  # noqa: F401  (register)


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLE)
from kintsugi.plans import quality_queries  # noqa: F401,E402
from kintsugi.plans import score_log_queries  # noqa: F401,E402
from kintsugi.plans import flagship  # noqa: F401,E402
from kintsugi.plans import stream_queries  # noqa: F401,E402
from kintsugi.plans import byproduct_queries  # noqa: F401,E402
from kintsugi.plans import version_queries  # noqa: F401,E402
