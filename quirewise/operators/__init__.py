"""Quirewise operators."""
