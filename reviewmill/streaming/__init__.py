"""Structured Streaming jobs of the event feed."""
