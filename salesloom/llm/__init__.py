"""Operators for preparing training data from a table of documents."""
