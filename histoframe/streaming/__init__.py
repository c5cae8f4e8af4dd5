"""Structured Streaming forms of the extract and status stages."""
