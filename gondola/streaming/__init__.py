"""Continuous arrival of day files."""
