"""Operators for preparing language-model training text.

Nothing else in the library imports this package. Every operator works on a frame
of documents (or pages), takes column names as parameters, ignores all other
columns and never uses a column it did not name.
"""
