"""Batch operators, one module per theme. Every operator is a function from DataFrames to a DataFrame."""
