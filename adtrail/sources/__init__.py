"""Readers, writers and the mapping of the given tables."""
