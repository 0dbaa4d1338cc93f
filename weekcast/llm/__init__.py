"""Operators for building training data: one module per operator, queries in ``queries.py``.

Nothing else in the library imports this subpackage.
"""
