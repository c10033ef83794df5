"""Relational building blocks; column names are arguments where it makes sense."""
