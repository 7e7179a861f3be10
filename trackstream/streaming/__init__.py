"""Structured Streaming job, stateful operators and sinks."""
