"""Structured Streaming ingest of append-only files."""
