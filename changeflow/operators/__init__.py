"""Operators over batch or streaming DataFrames."""
