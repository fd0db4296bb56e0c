"""Masking of streams."""
