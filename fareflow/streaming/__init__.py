"""Structured Streaming queries. The transforms are the batch operators."""
