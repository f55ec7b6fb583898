"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` applies
them to the whole tables.  Nothing outside this package imports it.
"""
