"""Schemas, readers, writers and fixed dimensions."""
