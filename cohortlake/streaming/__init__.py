"""Incremental loads and streaming reconciliation."""
