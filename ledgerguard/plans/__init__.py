"""Registered queries (one per SURVEY §2 operator) and their DuckDB oracles."""
