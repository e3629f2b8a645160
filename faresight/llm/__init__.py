"""Operators for large-scale training-data preparation (documents, pages, URLs)."""
