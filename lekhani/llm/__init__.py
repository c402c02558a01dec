"""Operators for preparing language-model training text.

Nothing outside this subpackage imports it; ``queries.py`` holds the query
registry and the DuckDB statements that check it.
"""
