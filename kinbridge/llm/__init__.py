"""Operators for training corpora: scoring, mixing, search, counting, near duplicates,
tokens and archives.  Nothing else of the library imports this package."""
