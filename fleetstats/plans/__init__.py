"""Registered queries: each runs an operator over the given tables, most with a SQL twin."""
