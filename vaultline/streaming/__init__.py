"""Structured Streaming loaders."""
