"""Queries over the tables."""
