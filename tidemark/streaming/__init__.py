"""Incremental apply of change logs with Structured Streaming."""
