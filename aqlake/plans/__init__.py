"""Derived tables put together from the operators."""
