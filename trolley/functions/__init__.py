"""Scalar column functions (all built from Spark's own functions)."""
