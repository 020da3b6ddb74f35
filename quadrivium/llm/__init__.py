"""Operators for training-data pipelines: scoring, packing, deduplication, tokenizing, secret scans, quality.

Nothing outside this package imports it.  ``jobs`` binds the operators to the driver's tables.
"""
