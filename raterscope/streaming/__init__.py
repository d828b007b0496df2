"""Incremental ingest with file-source Structured Streaming."""
