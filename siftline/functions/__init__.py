"""Scalar expressions, row filters and encodings."""
