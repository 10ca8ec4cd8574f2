"""Operators for preparing large training corpora, and their queries.

Nothing outside this package imports it except ``corpus_pipeline.py`` and the
guarded lines of ``__spark_entry__.py``.
"""
