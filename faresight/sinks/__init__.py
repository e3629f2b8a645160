"""Writers: files, catalog tables, insert-only merge, loads with state, messages."""
