"""Masking functions."""
