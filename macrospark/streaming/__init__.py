"""Structured Streaming over landed rows."""
