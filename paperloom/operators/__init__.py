"""Paperloom operators."""
