"""Structured Streaming forms of the incremental reducers."""
