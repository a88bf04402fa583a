"""Readers, writers, table layout and ingest positions."""
