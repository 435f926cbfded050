"""Operators for training-data pipelines: deduplication, filtering, scoring, packing, sharding.

Nothing else in the package imports this subpackage.
"""
