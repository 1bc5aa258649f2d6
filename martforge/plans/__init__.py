"""Composed datasets and the registered query catalog."""
