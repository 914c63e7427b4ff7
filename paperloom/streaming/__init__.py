"""Paperloom streaming."""
