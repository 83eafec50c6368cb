"""Operators for training-data pipelines over corpora of documents, pages and vectors.

Nothing else in the library imports this subpackage.
"""
