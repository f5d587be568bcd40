"""Structured Streaming views."""
