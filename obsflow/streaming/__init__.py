"""Structured Streaming forms of the landing and deduplication steps."""
