"""Operators of a training-data pipeline: cleaning, screening, near-duplicates, search, shards, tokens."""
