"""Operators of a training-data pipeline: filters, scans, deduplication, packing."""
