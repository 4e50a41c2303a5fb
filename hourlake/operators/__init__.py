"""Operators on hourly frames."""
