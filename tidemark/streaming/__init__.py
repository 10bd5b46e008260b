"""Batches that arrive over time."""
