"""Relational building blocks; every function maps DataFrames to a DataFrame unless stated."""
