"""Readers of the raw files and tables, and the writers between stages."""
