"""Structured Streaming over landed page files."""
