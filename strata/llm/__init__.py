"""Operators for training-data pipelines: deduplication, filters, tokenizing, packing and search."""
