"""Incremental ingest and continuous windows on Structured Streaming."""
