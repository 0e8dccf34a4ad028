"""Registered queries (one per operator) and their DuckDB oracles."""
