"""Incremental refresh."""
