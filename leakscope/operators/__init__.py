"""Relational building blocks of the analyses."""
