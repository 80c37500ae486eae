"""Operators of a training-data pipeline: filters, scores, near-duplicates, mixing and packing."""
