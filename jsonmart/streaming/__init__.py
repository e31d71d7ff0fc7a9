"""Incremental runs on Structured Streaming file sources."""
