"""Layers and jobs composed from the operators."""
