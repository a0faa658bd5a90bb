"""Structured Streaming forms of the stages that make sense on a stream."""
