"""Operators of a training-data pipeline, each a ``DataFrame -> DataFrame`` function.

Nothing outside this package imports it except ``__spark_entry__.py`` (guarded) and
``corpus_pipeline.py``.  ``queries.QUERIES`` maps query names to callables, ``queries.SQL``
holds the DuckDB oracles.
"""
