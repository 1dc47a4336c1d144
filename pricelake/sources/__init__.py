"""Readers: landed documents, declared silver tables, CSV dimensions."""
