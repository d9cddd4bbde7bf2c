"""Column-to-column helpers."""
