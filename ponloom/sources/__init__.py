"""Readers: files to DataFrames with fixed schemas."""
