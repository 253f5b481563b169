"""Operators and queries for preparing training text and vectors.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""
