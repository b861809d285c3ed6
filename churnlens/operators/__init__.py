"""Relational, profiling, preparation, model and evaluation operators."""
