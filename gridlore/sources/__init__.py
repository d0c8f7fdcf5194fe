"""Readers, writers and the source registry."""
