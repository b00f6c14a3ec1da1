"""Registered queries with their oracles, grouped by topic."""
