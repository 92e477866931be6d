"""Incremental loads and windowed aggregates on Structured Streaming."""
