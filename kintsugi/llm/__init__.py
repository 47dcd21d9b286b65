"""Operators for large text corpora used as training data.

Nothing else in the library imports this package; its queries are added to
the catalogue by ``__spark_entry__.py`` only.
"""
