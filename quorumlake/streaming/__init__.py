"""Structured Streaming forms of the polling jobs."""
