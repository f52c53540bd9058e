"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries.py``
registers the thin query of each.  Nothing outside this folder imports it.
"""
