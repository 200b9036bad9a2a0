"""Whole jobs made of operators, sources and sinks."""
