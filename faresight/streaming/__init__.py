"""Structured Streaming: trip messages in and out, session-window counts."""
