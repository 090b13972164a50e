"""Operators of a large-scale training-data pipeline, each by a named method.

Nothing else in the library imports this subpackage; its contract queries
and their SQL are in ``queries.py`` / ``oracle.py``.
"""
