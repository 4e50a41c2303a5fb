"""Hourly forecast and observation analytics on Spark."""
