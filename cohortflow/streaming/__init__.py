"""Structured Streaming jobs composed from the batch operators."""
