"""Operators of a training-data pipeline over the document tables.

Nothing else in the library imports this package. ``OPS`` maps a registered query
name to its callable, ``SQL`` to its DuckDB twin where SQL can express the operator.
"""
