"""Operators for training corpora: packing, deduplication, scoring, storage, search, mixing, formatting."""
