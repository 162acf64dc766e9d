"""Structured Streaming forms of the live monitor."""
