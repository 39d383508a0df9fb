"""Incremental Bronze -> Silver runs with Structured Streaming."""
