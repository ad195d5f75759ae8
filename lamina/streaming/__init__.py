"""Arriving files through Structured Streaming."""
