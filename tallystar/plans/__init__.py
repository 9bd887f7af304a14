"""Whole runs over a warehouse."""
