"""Operators on tables: types, versions, run log, latency, ranks."""
