"""Composed plans: raw records to bronze, staging, marts, and the refresh of a table."""
