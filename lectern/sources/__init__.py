"""Readers, writers and materialised stages."""
