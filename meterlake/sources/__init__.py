"""Readers: landing files, lake tables, masters."""
