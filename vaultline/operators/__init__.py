"""Operators on change-event and vault DataFrames."""
