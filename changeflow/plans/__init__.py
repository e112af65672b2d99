"""Queries: each runs library operators over the given tables."""
