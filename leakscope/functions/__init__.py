"""Cleaning rules and arithmetic, all made of built-in Spark expressions."""
