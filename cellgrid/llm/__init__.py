"""Operators for preparing language-model training data.

Nothing outside this package imports it; deleting the folder leaves the rest
of the library working.
"""
