"""Whole jobs and queries put together from the operators."""
