"""Structured Streaming versions of feed checks."""
