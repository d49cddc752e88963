"""Operators of a training-data pipeline: encoding, dedup, packing, search, scoring.

Nothing else in the library imports this package.  ``queries.py`` holds its registry entries.
"""
