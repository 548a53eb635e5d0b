"""Queries and their registry."""
