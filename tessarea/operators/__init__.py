"""Relational operators, all DataFrame to DataFrame."""
