"""Operators for large text corpora, each a function from DataFrame to DataFrame."""
