"""Feeds, files, master data and tables."""
