"""Structured Streaming flows and sinks."""
