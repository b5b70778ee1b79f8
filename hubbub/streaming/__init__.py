"""Structured Streaming forms of ingest, dedup, hourly volume and top terms."""
