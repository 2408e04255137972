"""Structured Streaming trigger for the daily job: re-run the dates that received new events."""
