"""Incremental event ingestion and incremental model updates (Structured Streaming)."""
