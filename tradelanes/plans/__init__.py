"""Compositions: analogue inputs, silver and gold layers, serving queries, the
query registry and its DuckDB oracle SQL."""
