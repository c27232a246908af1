"""Structured Streaming: the standardisation operators applied to arriving files."""
