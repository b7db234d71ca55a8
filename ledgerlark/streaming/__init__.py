"""Structured Streaming forms of the refreshable steps."""
