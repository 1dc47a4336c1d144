"""Relational building blocks shared by the silver and gold plans."""
