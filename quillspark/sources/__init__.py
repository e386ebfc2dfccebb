"""Readers, writers and the views that map the driver's tables onto posts."""
