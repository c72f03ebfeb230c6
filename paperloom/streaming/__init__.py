"""Structured Streaming: answers that arrive as files over time."""
