"""Schemas, landed extracts and history tables."""
