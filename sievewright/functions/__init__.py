"""Catalog, merge and quality operators over captured responses."""
