"""Structured Streaming form of the session replay."""
