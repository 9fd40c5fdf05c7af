"""Incremental refresh of the latest sources."""
