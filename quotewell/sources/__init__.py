"""Readers, writers, stage tables and run records."""
