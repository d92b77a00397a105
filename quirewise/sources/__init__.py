"""Quirewise sources."""
