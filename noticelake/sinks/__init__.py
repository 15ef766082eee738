"""Writes: keyed tables, period partitions, JSON."""
