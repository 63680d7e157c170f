"""Scans, sinks and loads."""
