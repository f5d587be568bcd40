"""User-level operators, grouped by subject."""
