"""Structured Streaming: intake, rolling counts, live top K."""
