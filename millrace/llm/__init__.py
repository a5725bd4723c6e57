"""Operators for large text corpora: deduplication, filters, mixing, token files."""
