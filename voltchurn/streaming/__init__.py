"""Structured Streaming forms of the incremental jobs (ST1-ST3)."""
