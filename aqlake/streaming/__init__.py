"""Continuous ingest of document files and incremental refresh of derived tables."""
