"""Incremental landing: bronze files -> silver tables with Structured Streaming."""
