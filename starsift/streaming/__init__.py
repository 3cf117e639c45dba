"""Batch jobs offered on Structured Streaming."""
