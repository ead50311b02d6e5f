"""Operators for large training-data pipelines.

Nothing else in the library imports this package. Each module holds one
operator; ``queries`` applies them to the test tables.
"""
