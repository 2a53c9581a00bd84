"""Structured Streaming jobs for news and bars."""
