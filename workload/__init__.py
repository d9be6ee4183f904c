"""Queries that exercise the library on the test tables, with an independent SQL text for each."""
