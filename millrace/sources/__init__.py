"""Readers and managed tables."""
