"""Structured Streaming sources, stateful results and sinks."""
