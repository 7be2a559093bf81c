"""Whole jobs: ingest, clean, resolve, check, export."""
