"""Reusable DataFrame operators (DataFrame(s) -> DataFrame, built-in functions only)."""
