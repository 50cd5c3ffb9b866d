"""Structured Streaming forms of the jobs that follow a growing landing folder."""
