"""Structured Streaming: request decoding, de-duplication, scoring and sinks."""
