"""Declared configuration and the registered queries over the given tables."""
