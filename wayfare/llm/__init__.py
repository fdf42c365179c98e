"""Operators of a training-data pipeline: mixing, packing, extraction, near-duplicates, token files and filters."""
