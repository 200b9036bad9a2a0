"""Readers, sinks and the keyed store."""
