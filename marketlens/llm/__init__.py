"""Operators for training-data corpora: quality, duplicates, tokens, contamination, scoring.

Nothing outside this folder imports it.
"""
