"""Operators, one module per family of work."""
