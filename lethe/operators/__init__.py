"""Relational building blocks of erasure and masking."""
