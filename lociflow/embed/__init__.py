"""Sequence embedders, and embedding of a column with a cache."""
