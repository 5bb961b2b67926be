"""Readers, writers and catalog helpers."""
