"""Readers, writers and catalog access."""
