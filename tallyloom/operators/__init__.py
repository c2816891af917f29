"""Operators over DataFrames: profiling, reports, tools, keys, text and vectors."""
