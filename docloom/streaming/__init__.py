"""Incremental (available-now) table builds on Structured Streaming."""
