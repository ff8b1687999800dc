"""Readers, writers and views over the driver tables."""
