"""Incremental pick-up of landed payload files."""
