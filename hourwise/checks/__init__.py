"""Registered queries over the provided tables and their DuckDB oracle SQL."""
