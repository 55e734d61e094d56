"""Readers, writers and the role views over the test tables."""
