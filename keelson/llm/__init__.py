"""Operators of a training-data pipeline (one module each), their queries and SQL.

Nothing else in the library imports this package.
"""
