"""Dedup, buffer and accounting operators on DataFrames."""
