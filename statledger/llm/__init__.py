"""Operators for training-data pipelines: scoring, deduplication, screening, token output and packing."""
