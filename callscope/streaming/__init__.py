"""Structured Streaming forms of the jobs; same rows as in batch."""
