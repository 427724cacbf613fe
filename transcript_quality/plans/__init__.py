"""Composed jobs a user calls (each a short chain of operators over DataFrames)."""
