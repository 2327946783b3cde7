"""Structured Streaming form of the incremental jobs."""
