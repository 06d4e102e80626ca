"""Scalar column functions (calendar, text, statistics)."""
