"""Operators for training-data corpora: filtering, deduplication, counting, mixing and sharding."""
