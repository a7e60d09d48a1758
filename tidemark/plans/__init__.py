"""Whole plans: incremental sync, post archives and media."""
