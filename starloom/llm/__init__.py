"""Operators over documents, vectors and pages for preparing training data.

Nothing else in the library imports this package; it may import the library's general helpers.
"""
