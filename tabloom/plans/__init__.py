"""Whole workflows, and the queries with their SQL checks."""
