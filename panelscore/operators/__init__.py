"""Relational and ML operators: each takes and returns DataFrames."""
