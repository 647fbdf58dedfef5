"""Structured Streaming: poll files to tables, current state, duplicate readings."""
