"""Incremental file-to-table pipelines on Structured Streaming."""
