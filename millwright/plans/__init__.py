"""Layers composed from the operators."""
