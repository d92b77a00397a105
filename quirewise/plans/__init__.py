"""Registered queries of the core, each with its SQL where SQL expresses it."""
