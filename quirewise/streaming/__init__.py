"""Quirewise streaming."""
