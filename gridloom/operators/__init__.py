"""Relational operators over parsed tables."""
