"""Readers and the derived inputs that stand for platform tables."""
