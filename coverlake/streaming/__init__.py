"""Structured Streaming forms of the incremental layer."""
