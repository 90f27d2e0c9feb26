"""Structured Streaming: topic parsing, scoring, sinks, duplicates, response matching."""
