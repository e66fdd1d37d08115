"""Structured Streaming forms of file pickup and hourly counting."""
