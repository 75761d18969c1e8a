"""Operators that prepare text corpora: deduplication, filters, counts and mixing."""
