"""Structured Streaming additions."""
