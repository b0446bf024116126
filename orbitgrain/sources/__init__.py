"""Scans, views and sinks."""
