"""Relational building blocks with column roles, shared by every report and collector."""
