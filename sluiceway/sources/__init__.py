"""Readers: tables, raw zones, text formats, relational databases and message streams."""
