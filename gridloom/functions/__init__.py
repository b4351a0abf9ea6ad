"""Scalar rules: names, text, types."""
