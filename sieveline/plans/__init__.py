"""Catalogs of named queries over a directory of tables."""
