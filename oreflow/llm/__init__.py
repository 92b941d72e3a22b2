"""Operators for training-data pipelines: search, deduplication, tokenising, extraction, filtering, packing."""
