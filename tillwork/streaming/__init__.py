"""Structured Streaming jobs, their sinks, and the roll-ups of what they write."""
