"""Batch-replacing sinks."""
