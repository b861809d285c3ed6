"""Composed feature queries and the registry of named queries."""
