"""Structured Streaming jobs over the same aggregates as the batch jobs."""
