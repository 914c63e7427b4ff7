"""Paperloom functions."""
