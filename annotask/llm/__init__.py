"""Operators of a training-data pipeline over document and conversation tables.

Nothing else in the library imports this subpackage.
"""
