"""Equivalent SQL of the registered queries."""
