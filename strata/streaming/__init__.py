"""Structured Streaming ingest: available-now drains, per-batch quality split, dedup."""
