"""Relational operators: latest state, share of voice, lookups, tags, ranks, trends, metrics."""
