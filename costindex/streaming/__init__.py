"""Structured Streaming form of the incremental monthly load."""
