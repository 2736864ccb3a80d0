"""Structured Streaming tables and the keyed upsert."""
