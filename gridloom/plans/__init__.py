"""Whole plans: profiling, loading into snapshot tables, derived documents."""
