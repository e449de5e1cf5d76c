"""Operators of a training-data pipeline: deduplication, quality, tokens, privacy, mixing, formatting, archives.

Nothing outside this folder imports it. Each operator takes and returns DataFrames; ``queries`` applies them to the given tables.
"""
