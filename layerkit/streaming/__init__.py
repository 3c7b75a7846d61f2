"""Structured Streaming: file ingest (copy once per file) and incrementally maintained tables."""
