"""Operators of a training-data pipeline: scoring, filters, deduplication, packing."""
