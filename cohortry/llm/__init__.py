"""Operators of a training-data pipeline: quality, language, duplicates, tokens, search, scoring, extraction, packing.

Nothing else in the library imports this package. Each operator takes and returns DataFrames; ``queries`` registers one
query for each of them.
"""
