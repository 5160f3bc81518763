"""Operators of a training-data pipeline: texts, pages and their filters.

Nothing outside this subpackage imports it; ``registry`` holds the registered
queries (``op1_`` to ``op10_``) and their DuckDB twins.
"""
