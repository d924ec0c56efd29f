"""Structured Streaming ingest (K1-K4)."""
