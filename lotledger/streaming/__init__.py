"""Structured Streaming form of the resumable collection."""
