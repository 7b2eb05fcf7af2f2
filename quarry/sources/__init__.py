"""Scans, file sources and sinks."""
