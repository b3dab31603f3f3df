"""Operators for large text corpora: deduplication, filtering, mixing, packing, token files."""
