"""Readers: archives, catalogue databases, delimited and block text, file listings."""
