"""Operators of a training-data pipeline: mixing, de-duplication, filters, shards, archives."""
