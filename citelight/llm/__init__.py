"""Operators for preparing training text: language, duplicates, leaks, mixing, archives and token files."""
