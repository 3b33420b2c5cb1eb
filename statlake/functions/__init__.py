"""Column-level functions: header names, period parsing, measure cleaning."""
