"""Composite plans: the registered queries, the model layer, ingest and loads."""
