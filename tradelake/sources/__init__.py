"""Readers of responses, manifests, dimensions, HTML tables and spreadsheets."""
