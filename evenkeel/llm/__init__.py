"""Operators for training-data pipelines, and the queries that apply them.

Nothing else in the library imports this subpackage.
"""
