"""Incremental runs over newly landed files with Structured Streaming."""
