"""Readers, writers and flatteners for landed tables."""
