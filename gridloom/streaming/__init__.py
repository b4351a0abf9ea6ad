"""Artifacts as they arrive."""
