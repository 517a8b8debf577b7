"""Scans of landed documents and of stored tables."""
