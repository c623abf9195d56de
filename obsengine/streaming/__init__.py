"""Structured Streaming entry points (landing files → current state)."""
