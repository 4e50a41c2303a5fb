"""Sinks: landing lines and published tables."""
