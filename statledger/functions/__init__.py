"""Column-level helpers: integer arithmetic, calendar parts and text."""
