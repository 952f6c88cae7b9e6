"""Structured Streaming jobs for the macro feed."""
