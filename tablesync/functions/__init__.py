"""Scalar functions, the type map and repeatable random columns."""
