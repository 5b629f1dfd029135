"""Incremental forms on Structured Streaming."""
