"""Continuous versions of the collectors and reports on Structured Streaming."""
