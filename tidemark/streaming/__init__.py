"""Structured Streaming forms of the snapshot loads."""
