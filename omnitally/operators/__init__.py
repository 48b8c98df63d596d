"""Relational operators of the engine, each a function from DataFrames to a DataFrame."""
