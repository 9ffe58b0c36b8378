"""Readers with fixed schemas, and sinks."""
