"""Structured Streaming forms of the vessel operators."""
