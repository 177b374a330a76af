"""Incremental curation with Structured Streaming (optional, not parity)."""
