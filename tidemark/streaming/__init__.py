"""Structured Streaming versions of the periodic jobs."""
