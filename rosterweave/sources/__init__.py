"""Readers. Every row they return carries a unique ``ingest_ordinal`` that follows file order."""
