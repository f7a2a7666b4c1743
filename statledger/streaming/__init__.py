"""Structured Streaming forms of the file sources."""
