"""Readers and writers: raw log text, tables, requests, streams."""
