"""Incremental loads."""
