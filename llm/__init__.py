"""Operators for training-data pipelines; nothing else in the repository imports this package."""
