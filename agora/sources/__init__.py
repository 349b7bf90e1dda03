"""Readers: JSON and HTML search results, stored tables, sample posts."""
