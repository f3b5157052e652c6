"""Operators of a training-data pipeline: tokenising, deduplicating, filtering, packing.

Every module holds one operator with its own general interface; ``queries`` holds
the registered queries that apply them to the given tables.
"""
