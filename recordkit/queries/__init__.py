"""Registered queries over the given tables, each with independent SQL."""
