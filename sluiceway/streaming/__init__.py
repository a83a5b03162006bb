"""Structured Streaming jobs. Each batch function has a bounded twin in ``operators`` or ``plans``."""
