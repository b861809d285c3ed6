"""Operators for building training corpora, and the queries that apply them.

Nothing else in the library imports this package.  Each module holds one
operator with its general interface; ``queries`` holds the thin registered
queries (``op1_...`` to ``op13_...`` and ``pipeline``).
"""
