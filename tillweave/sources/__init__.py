"""Readers, writers and the binding of the sample tables."""
