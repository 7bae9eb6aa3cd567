"""Structured Streaming jobs; each agrees with a batch operator."""
