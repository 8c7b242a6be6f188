"""Operators for training-data pipelines over a table of documents.

Nothing else in the library imports this subpackage.
"""
