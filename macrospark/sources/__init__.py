"""Readers, writers, inline dimensions and the versioned table."""
