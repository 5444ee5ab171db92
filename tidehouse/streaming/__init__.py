"""Streaming forms of the transforms, their state and their sinks."""
