"""Relational operators: every entry maps DataFrames to a DataFrame."""
