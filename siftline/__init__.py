"""Keyed dedup and buffer-and-sort for record logs, on Spark DataFrames and streams."""

__version__ = "0.1.0"
