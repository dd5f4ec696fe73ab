"""Structured Streaming form of the delta mirror."""
