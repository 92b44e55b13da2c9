"""Incremental ingestion with Structured Streaming (file source, availableNow)."""
