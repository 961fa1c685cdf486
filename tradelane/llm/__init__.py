"""Operators for training-data corpora: filtering, deduplication, extraction, mixing, packing."""
