"""Structured Streaming form of landing + preprocessing (only new log files)."""
