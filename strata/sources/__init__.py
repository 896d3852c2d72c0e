"""Readers (declared schemas, lineage, rescued fields) and writers (conform, run-keyed)."""
