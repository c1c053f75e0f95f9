"""Incremental forms of ingest and of the scope counters."""
