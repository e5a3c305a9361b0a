"""Operators, DataFrame to DataFrame."""
