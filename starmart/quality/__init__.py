"""Declarative data-quality checks."""
