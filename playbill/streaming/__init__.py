"""Incremental ingestion of new pages."""
