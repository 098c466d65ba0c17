"""Structured Streaming forms of the incremental builds."""
