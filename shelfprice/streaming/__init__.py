"""Structured Streaming: incremental ingest of pages as they land."""
