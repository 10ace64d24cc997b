"""Structured Streaming jobs on ticks and rollups."""
