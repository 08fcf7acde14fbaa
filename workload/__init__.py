"""Queries over the given tables: views, Spark queries and their DuckDB oracles."""
