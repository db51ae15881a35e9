"""Structured Streaming sources, event-time operators, state and sinks."""
