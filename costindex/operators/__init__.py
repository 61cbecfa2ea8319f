"""Reusable DataFrame operators.  Each takes DataFrames plus parameters and returns a DataFrame."""
