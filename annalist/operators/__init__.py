"""Batch operators: history, projection, relational shapes, quality, resolution and release."""
