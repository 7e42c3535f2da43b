"""Operators of a training-data pipeline.

Nothing else in the library imports this package; it may import general
helpers (session, checkpoint folder) from the library.
"""
