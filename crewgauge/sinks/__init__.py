"""Stored tables, flat extracts and the result document."""
