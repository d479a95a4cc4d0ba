"""Reporting queries over the stored tables."""
