"""Operators for cleaning, deduplicating and mixing text corpora.

Nothing else in the library imports this subpackage.
"""
