"""Relational building blocks; each is a function from DataFrames to a DataFrame."""
