"""Operators of a training-data pipeline: filtering, deduplication, mixing, encoding, sharding, search."""
