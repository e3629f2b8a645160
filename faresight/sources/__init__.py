"""Readers: driver tables, file formats, catalog, and the taxi adapter."""
