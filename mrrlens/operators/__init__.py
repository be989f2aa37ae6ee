"""Reusable relational operators: top row per key, revenue timeline, versions, checks."""
