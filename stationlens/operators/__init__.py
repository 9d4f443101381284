"""Relational operators over DataFrames; column names are parameters."""
