"""Operators for training-data pipelines: scoring, filters, duplicates, mixing, sharding, archives."""
