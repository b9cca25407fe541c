"""Queries over the sample tables, and the same answers written as plain SQL."""
