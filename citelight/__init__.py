"""Citelight: batch analytics on how brands appear in the answers of AI assistants.

Every operator is a function from DataFrames to a DataFrame; nothing here runs
a job unless its name says so (``append_rows``, ``replace_table``, ``daily_load``).
"""
