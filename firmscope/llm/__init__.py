"""Operators for preparing training data: counting, filtering, deduplication, search, encoding and packing.

Nothing else in the package imports this subpackage.
"""
