"""Scans: landed pages and stored tables."""
