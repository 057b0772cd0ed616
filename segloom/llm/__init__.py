"""Operators of a training-data pipeline: filters, duplicates, tokens, packing, scoring.

Nothing outside this subpackage imports it.
"""
