"""Incremental ingestion: new raw files in a folder are loaded batch by batch."""
