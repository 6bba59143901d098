"""Sinks: replay-safe vault storage with keyed reads."""
