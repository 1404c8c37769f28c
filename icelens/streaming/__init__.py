"""Incremental arrival of data (resumable appends)."""
