"""Structured Streaming forms of drift, scoring and segment rates."""
