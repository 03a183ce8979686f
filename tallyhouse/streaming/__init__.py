"""Structured Streaming forms of the live-feed operators; ``operators.history`` holds the batch forms."""
