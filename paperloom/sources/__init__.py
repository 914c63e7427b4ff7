"""Paperloom sources."""
