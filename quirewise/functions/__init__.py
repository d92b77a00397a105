"""Quirewise functions."""
