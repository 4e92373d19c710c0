"""Incremental ingest of landed files and the touched-day refresh."""
