"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; each module holds one
operator, ``registry`` holds the thin queries over the test tables.
"""
