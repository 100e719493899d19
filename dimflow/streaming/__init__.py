"""Structured Streaming intake of landed files."""
