"""Incremental use of the jobs with Structured Streaming."""
