"""Loads driven by newly landed files."""
