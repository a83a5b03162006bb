"""Spark data-processing toolkit for device telemetry, order flow and message data."""
