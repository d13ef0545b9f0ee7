"""Runs over many tables, sample data, and the registered queries."""
