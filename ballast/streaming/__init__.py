"""Continuous ingestion of cash events and price ticks."""
