"""Structured Streaming form of the click feature builder."""
