"""Operators of a training-data pipeline: sharding, mixing, deduplication,
quality scoring, packing, token files and vector search.

Nothing else in the library imports this subpackage.
"""
