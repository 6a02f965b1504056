"""Operators: reusable DataFrame compositions (dedup, keys, joins, OLAP,
quality checks).  Each is a function from DataFrames to a DataFrame."""
