"""Structured Streaming jobs over change envelopes."""
