"""Structured Streaming form of the scoring plan."""
