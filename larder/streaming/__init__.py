"""Structured Streaming in place of polling queues."""
