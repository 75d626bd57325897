"""Bounded catch-up with Structured Streaming."""
